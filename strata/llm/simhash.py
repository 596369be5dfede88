"""SimHash near-duplicates, compared bit-sliced.

Fingerprints. Words are taken after lower-casing A-Z; every run of three words
is a shingle, hashed with XXH64; a fingerprint bit is set if more than half of
the shingle hashes have it. Numpy does this for a slice of texts at a time: the
hash runs over all shingles at once, and the 64 bit counts are kept as eight
byte counters in each of eight machine words.

Links. Fingerprints at ``radius`` or fewer differing bits agree in at least one
of radius + 1 blocks of bits, so only those sharing a block are compared. The
fingerprints of a block value lie one after the other, their bits turned into
64 vertical planes; shifting the planes by d compares every fingerprint with
the d-th after it. Distances of 64 pairs at a time are summed by carry-save
counters over words, and a word is abandoned once all its pairs exceed the
radius. A block value with more than CHUNK fingerprints is dealt out as pairs
of chunks, so that no task gets it whole, and every pair still meets.

Only distinct fingerprints are compared, and what leaves a comparison is a
spanning forest of its links, never all pairs of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Texts, fresh, staged, text_slices
from strata.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
#: Fingerprints of one block value that one comparison takes from each side.
CHUNK = 1024

#: The five primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_slices(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = HASH_SEED) -> np.ndarray:
    """XXH64 of every ``buf[start:end]``, all slices at once.

    Slices are put in order of falling length, so the ones that still have
    bytes left are always a prefix of the arrays.
    """
    out = np.empty(len(start), dtype=np.uint64)
    if not len(start):
        return out
    order = np.argsort(-(end - start), kind="stable")
    at, size = start[order].copy(), (end - start)[order]
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    lane8 = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,)).copy()
    s = np.uint64(seed)

    def live(least: int) -> int:
        return int(np.searchsorted(-left, -least, side="right"))

    def mix(acc, lane):
        return _rotl(acc + lane * P2, 31) * P1

    with np.errstate(over="ignore"):
        h = np.full(len(at), s + P5, dtype=np.uint64)
        left = size
        n = live(32)
        if n:
            accs = [np.full(n, v, dtype=np.uint64) for v in (s + P1 + P2, s + P2, s, s - P1)]
            longest = size[:n]
            done = 0
            while (m := int(np.searchsorted(-longest, -(done + 32), side="right"))):
                for k in range(4):
                    accs[k][:m] = mix(accs[k][:m], lane8[at[:m] + (done + 8 * k)])
                done += 32
            total = _rotl(accs[0], 1) + _rotl(accs[1], 7) + _rotl(accs[2], 12) + _rotl(accs[3], 18)
            for acc in accs:
                total = (total ^ mix(np.uint64(0), acc)) * P1 + P4
            h[:n] = total
            at[:n] += (longest // 32) * 32
        h += size.astype(np.uint64)
        rest = size % 32
        again = np.argsort(-rest, kind="stable")
        at, left, h = at[again], rest[again], h[again]
        for step in range(3):  # eight bytes at a time
            if not (n := live(8 * (step + 1))):
                break
            h[:n] = _rotl(h[:n] ^ mix(np.uint64(0), lane8[at[:n] + 8 * step]), 27) * P1 + P4
        at += (left // 8) * 8
        tail = left % 8
        four = np.flatnonzero(tail >= 4)
        word = lane8[at[four]] & np.uint64(0xFFFFFFFF)
        h[four] = _rotl(h[four] ^ (word * P1), 23) * P2 + P3
        at[four] += 4
        tail = tail % 4
        for step in range(3):
            odd = np.flatnonzero(tail > step)
            h[odd] = _rotl(h[odd] ^ ((lane8[at[odd] + step] & np.uint64(0xFF)) * P5), 11) * P1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    out[order[again]] = h
    return out


def shingle_hashes(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, text after text, and how
    many each text has. A text of 1 to k - 1 words is one shingle."""
    lower = t.buf | ((t.buf >= 65) & (t.buf <= 90)).astype(np.uint8) << 5
    keep = np.zeros(len(lower) + 1, dtype=bool)
    keep[:-1] = ~((lower == 32) | ((lower >= 9) & (lower <= 13)))
    gap_after = t.end[(t.end < len(lower)) & ~keep[t.end]]
    keep[gap_after] = True  # one separator after each word
    lower[gap_after] = 32
    flat = lower[keep[:-1]]
    place = np.cumsum(keep) - keep
    start, end = place[t.start], place[t.end - 1] + 1
    count = np.where(t.n_words > 0, np.maximum(t.n_words - (k - 1), 1), 0)
    owner = np.repeat(np.arange(t.n), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = t.first_word[owner] + nth
    last = np.minimum(first + (k - 1), t.first_word[owner + 1] - 1)
    return xxh64_slices(flat, start[first], end[last]), count


def majority_bits(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each text, the bits set in more than half of its hashes."""
    runs = -(-count // 255)  # a byte counter holds 255
    owner = np.repeat(np.arange(len(count)), runs)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = (np.cumsum(count) - count)[owner] + 255 * nth
    totals = np.zeros((len(count), 64), dtype=np.int64)
    if len(start):
        per_text = np.flatnonzero(runs)
        edge = (np.cumsum(runs) - runs)[per_text]
        for bit in range(8):
            lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
            bytes_ = np.add.reduceat(lanes, start).astype("<u8").view(np.uint8).reshape(-1, 8)
            totals[per_text, bit::8] = np.add.reduceat(bytes_.astype(np.int64), edge, axis=0)
    bits = (2 * totals > count[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, keys: Sequence[str], text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``keys`` and ``fp`` (the 64 bits as a long) of every row. A text
    without words, or NULL, has fingerprint zero."""
    col = fresh(docs, "__text")
    narrow = docs.select(*keys, F.col(text).alias(col))
    out = narrow.select(*keys, F.lit(0).cast("long").alias("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = [majority_bits(*shingle_hashes(t, shingle_words)) for _, t in text_slices(texts)]
            fps = np.concatenate(fps) if fps else np.empty(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps.view(np.int64))],
                names=[*batch.schema.names[:-1], "fp"])

    return narrow.mapInArrow(run, out.schema)


def close_pairs(fps: np.ndarray, reach: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with i < j <= i + reach[i] at ``radius`` or fewer
    differing bits, a shift at a time, by bit-sliced comparison."""
    n = len(fps)
    if n < 2:
        return
    width = n // 64 + 2
    rows = np.zeros((64, width * 64), dtype=np.uint8)
    rows[:, :n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    planes = np.packbits(rows, axis=1, bitorder="little").view("<u8")
    del rows
    planes = planes[np.arange(64).reshape(4, 16).T.ravel()]  # spread the block that all share
    depth = radius.bit_length()
    bias = (1 << depth) - 1 - radius  # counters overflow when the distance passes the radius
    lanes = np.zeros(width * 64, dtype=bool)
    for d in range(1, int(reach.max(initial=0)) + 1):
        lanes[:n] = reach >= d
        live = np.packbits(lanes, bitorder="little").view("<u8")
        at = np.flatnonzero(live)
        live = live[at]
        skip, shift = divmod(d, 64)
        over = ~live
        counters = [np.full(len(at), ~np.uint64(0) if bias >> k & 1 else np.uint64(0)) for k in range(depth)]
        for p in range(0, 64, 8):
            block = planes[p:p + 8]
            later = block[:, at + skip]
            if shift:
                later = later >> np.uint64(shift) | block[:, at + skip + 1] << np.uint64(64 - shift)
            for carry in block[:, at] ^ later:
                for k in range(depth):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                over |= carry
            alive = over != ~np.uint64(0)
            if not alive.all():
                at, over = at[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(at):
                break
        if len(at):
            hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(hit)
            i = at[word] * 64 + bit
            yield i, i + d


def spanning_links(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each group (rows sorted by group)."""
    n = len(fps)
    last = np.searchsorted(group, group, side="right") - 1
    label = np.arange(n)
    for i, j in close_pairs(fps, last - np.arange(n), radius):
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            i, j = i[apart], j[apart]
            if not len(i):
                break
            np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while True:
                deeper = label[label]
                if np.array_equal(deeper, label):
                    break
                label = deeper
    child = np.flatnonzero(label != np.arange(n))
    return fps[child], fps[label[child]]


def _block_keys(fp: Column, radius: int) -> Column:
    """Array of radius + 1 keys: the block's number and its bits."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    keys = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        bits = F.shiftrightunsigned(fp, a) if b == 64 else F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        keys.append(bits * (radius + 1) + k if b - a < 56 else F.xxhash64(bits, F.lit(k)))
    return F.array(*keys)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect distinct values of column ``fp`` exactly as
    all pairs at ``radius`` or fewer differing bits would."""
    keyed = fps.select("fp", F.explode(_block_keys(F.col("fp"), radius)).alias("k"))
    sizes = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = keyed.join(sizes, "k").withColumn("parts", F.ceil(F.col("n") / chunk).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("own")))
    dealt = dealt.select("fp", "k", "own", F.explode(others).alias("other"))
    dealt = dealt.select("fp", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    dealt = dealt.repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi")

    def links(fp: np.ndarray, same: np.ndarray) -> pa.RecordBatch:
        a, b = spanning_links(fp.view(np.uint64), same, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last group, which may go on in the next batch
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            fp, k, lo, hi = cols
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            cut = int(np.flatnonzero(new)[-1]) if len(fp) else 0
            if cut:
                yield links(fp[:cut], np.cumsum(new[:cut]))
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]) > 1:
            yield links(held[0], np.zeros(len(held[0]), dtype=np.int64))

    return dealt.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (a hash of the text), fp,
    root (smallest fingerprint of the component) and component_id.

    component_id is the smallest doc_id in the component; NULL ids never are,
    so a component of NULL ids has NULL. Empty and NULL texts have fingerprint
    zero and are linked like any other. Repeated rows give a row each. Other
    columns of ``docs`` are ignored. An empty table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    narrow = narrow.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    marked = staged(fingerprints(narrow, ["doc_id", "text_key"], shingle_words=shingle_words), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(fingerprint_links(distinct.select("fp"), radius))
    labelled = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id")
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(labelled.select("fp", "root").join(smallest, "root"), "fingerprint-classes")
    return marked.join(classes, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id (a NULL id only if there is no other), then the smallest text_key.
    Rows that repeat both are one document; one of them stays."""
    marked = staged(near_copies(docs, doc_id, text, shingle_words, radius), "near-copies")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = marked.groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n"))
    kid, ktext = fresh(docs, "__kept_id"), fresh(docs, "__kept_text")
    kept = best.select(F.col("best.doc_id").alias(kid), F.col("best.text_key").alias(ktext))
    on = F.col(f"`{doc_id}`").eqNullSafe(F.col(kid)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(ktext))
    out = docs.join(kept, on, "left_semi")
    again = marked.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return out
    twice = again.select(F.col("doc_id").alias(kid), F.col("text_key").alias(ktext))
    single = out.join(twice, on, "left_anti")
    tkey = fresh(out, "__text_key")
    repeated = out.join(twice, on, "left_semi").withColumn(tkey, F.xxhash64(F.col(f"`{text}`")))
    return single.unionByName(repeated.dropDuplicates([doc_id, tkey]).drop(tkey))
