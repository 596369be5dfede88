"""Language-model scores by context-tree weighting over bytes.

A text is read as its lower-cased words, each followed by a space, the last by
a line feed: the line feed is the end token. Every byte is decomposed into
eight binary decisions, most significant bit first, each with a context tree of
its own. A node of a tree is a context (the last 0 to ``DEPTH`` bytes before
the byte; zeros before the text) and the bits already known. It estimates its
next bit by Krichevsky-Trofimov: (ones + 1/2) / (bits + 1).

Weighting mixes all depths. With E(s) the Krichevsky-Trofimov probability of
all bits that node s saw in training, and W(s) = (E(s) + product of W over the
contexts one byte longer) / 2 (W = E at the full depth), a node is trusted with
the share E(s) / (E(s) + product of W) of what the shorter contexts leave over.
What is left below the longest context seen in training predicts 1/2. So each
node holds one number: the probability of a one if it is the longest that
training saw.

Training counts the byte grams of DEPTH + 1 bytes. Contexts that end in the same
two bytes lie in the same task, at most 256 ** (DEPTH - 2) of them however large
the corpus: it works out their trees from the full depth up to two bytes, and
the mixture down again, relative to the shorter contexts. Those, at most
257 * 255 nodes, follow on the driver. Scoring walks the corpus once per block
of nodes. A block holds whole pairs of last context bytes and at most
``BLOCK_NODES`` nodes more than its largest pair has.

The base score needs each word's training count. Words with a 2 ** -20 share of
all words or more (at most 2 ** 20 of them) go along with the model; the counts
of the rare rest are joined by word, where no key is hot by construction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD_BREAK, staged

#: Bytes of context, at most 5: a gram and the number of its text share 64 bits.
DEPTH = 5
#: Nodes of a block that is sent to every task (12 bytes each).
BLOCK_NODES = 6 << 20
#: Words with this share of all words are sent to every task, if no longer than HOT_WORD_BYTES.
HOT_SHARE = 2.0 ** -20
HOT_WORD_BYTES = 32
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1 << 16

_SPACE = " \t\n\x0b\x0c\r"


def held_out_of_language(doc_id: Column) -> Column:
    """True for the rows that the model may not learn from (crc32 mod 7 is 2)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# ---------------------------------------------------------------- texts as bytes
class Slice:
    """Some texts as words and as bytes. ``words``: all words; ``word_text``:
    the text each belongs to; ``n_words`` per text. ``data``, once ``grams``
    needs it: the bytes, every text with DEPTH zeros before it; ``byte_text``
    and ``real`` (not one of the zeros) per byte; ``n_bytes`` per text."""

    def __init__(self, column: pa.Array, depth: int = DEPTH):
        self.n, self.depth = len(column), depth
        low = pc.ascii_trim(pc.ascii_lower(column.fill_null("").cast(pa.large_string())), characters=_SPACE)
        lists = pc.split_pattern_regex(low, pattern=WORD_BREAK)
        n_words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        blank = pc.equal(low, "").to_numpy(zero_copy_only=False)
        n_words[blank] = 0
        self.n_words = n_words
        flat = lists.flatten()
        self.words = flat.filter(pc.not_equal(flat, ""))
        self.word_text = np.repeat(np.arange(self.n), n_words)
        self._lists = lists

    def _bytes(self) -> None:
        """Work out ``data``, ``byte_text``, ``n_bytes`` and ``real``."""
        depth = self.depth
        start, end, space, nothing = (pa.scalar(x, pa.large_string()) for x in ("\0" * depth, "\n", " ", ""))
        whole = pc.binary_join_element_wise(start, pc.binary_join(self._lists, space), end, nothing)
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + self.n + 1]
        self.data = np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        self.byte_text = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(offsets))
        self.n_bytes = np.diff(offsets) - depth
        self.real = np.ones(len(self.data), bool)
        self.real[(starts[:, None] + np.arange(depth)).ravel()] = False

    def grams(self, size: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(gram, text) of every byte, ``size`` bytes at a time: the byte below
        the DEPTH bytes before it, the nearest in the lowest place."""
        k = self.depth
        if not hasattr(self, "data"):
            self._bytes()
        for lo in range(k, len(self.data), size):
            hi = min(lo + size, len(self.data))
            part = self.data[lo - k:hi].astype(np.uint64)
            gram = np.zeros(hi - lo, np.uint64)
            for j in range(k + 1):
                gram = (gram << np.uint64(8)) | part[j:j + hi - lo]
            real = self.real[lo:hi]
            yield gram[real], self.byte_text[lo:hi][real]


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES, depth: int = DEPTH) -> Iterator[tuple[int, Slice]]:
    """``column`` as (first row, ``Slice``) of about ``max_bytes``; a longer
    text is a slice of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(column):
        before = size[at - 1] if at else 0
        to = min(max(int(np.searchsorted(size, before + max_bytes, side="right")), at + 1), at + SLICE_ROWS)
        # ``take`` copies: string functions misread a slice that was cast in place
        yield at, Slice(column.take(pa.array(np.arange(at, to))), depth)
        at = to


class _Tally:
    """Counts per key of many slices, added up until ``most`` keys are held."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.held, self.size = most, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.held.append((keys, n))
        self.size += len(keys)
        if self.size > 2 * self.most:
            keys, n = self.merged()
            if len(keys) > self.most:
                yield keys, n
            else:
                self.held, self.size = [(keys, n)], len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([h[k] for h in self.held]) for k in (0, 1))
        self.held, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.add.reduceat(n, first) if len(first) else n


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n) of all texts; a gram may come several times."""
    def rows(keys, n):
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["gram", "n"])
    tally = _Tally()
    for batch in batches:
        for _, part in slices(batch.column("text")):
            for gram, _ in part.grams():
                for full in tally.add(*np.unique(gram, return_counts=True)):
                    yield rows(*full)
    if tally.held:
        yield rows(*tally.merged())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, n_train) of each slice."""
    for batch in batches:
        learns = ~batch.column("held").to_numpy(zero_copy_only=False)
        for at, part in slices(batch.column("text"), 2 * SLICE_BYTES):
            coded = part.words.dictionary_encode()
            code, k = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
            n_train = np.bincount(code[learns[at:at + part.n][part.word_text]], minlength=k)
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(np.bincount(code, minlength=k)), pa.array(n_train)],
                                             names=["word", "n", "n_train"])


# ---------------------------------------------------------------- trees
def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series eight places further up."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    for k in range(8):
        out = out - np.log(x + k)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    zeros, ones = np.asarray(zeros, np.float64), np.asarray(ones, np.float64)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


def _level(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None = None):
    """Sums per distinct node, and what follows from them: (nodes, which of
    them each row is, zeros, ones, estimate of a one, share of trust, ln W).
    ``below`` (ln W of each row) is None at the full depth."""
    nodes, of = np.unique(node, return_inverse=True)
    zeros, ones = (np.bincount(of, weights=v, minlength=len(nodes)) for v in (zeros, ones))  # exact below 2 ** 53
    own = log_kt(zeros, ones)
    kt = (ones + 0.5) / (zeros + ones + 1)
    if below is None:
        return nodes, of, zeros, ones, kt, np.ones(len(nodes)), own
    longer = np.bincount(of, weights=below, minlength=len(nodes))
    share = 1 / (1 + np.exp(np.clip(longer - own, -700, 700)))
    return nodes, of, zeros, ones, kt, share, np.logaddexp(own, longer) - math.log(2)


def _pair_trees(gram: np.ndarray, n: np.ndarray, depth: int) -> list[pa.RecordBatch]:
    """(depth, node, q, zeros, ones, weight) of all nodes with two or more
    bytes of context over whole pairs of last bytes. q is p with nothing mixed
    in by shorter contexts; the sums are given for two bytes only."""
    byte = gram & np.uint64(255)
    known = [gram & ~np.uint64(255) | (byte | np.uint64(256)) >> np.uint64(8 - j) for j in range(8)]
    one = [np.where(byte >> np.uint64(7 - j) & np.uint64(1), n, 0) for j in range(8)]
    ones = np.concatenate(one)
    levels = [_level(np.concatenate(known), np.tile(n, 8) - ones, ones)]
    for d in range(depth - 1, 1, -1):
        nodes, _, zeros, ones, _, _, weight = levels[-1]
        levels.append(_level(nodes & np.uint64((1 << 8 * (d + 1)) - 1), zeros, ones, weight))
    mixed, left, out = None, None, []
    for d in range(2, depth + 1):
        nodes, _, zeros, ones, kt, share, weight = levels[depth - d]
        if mixed is None:
            mixed, left = share * kt, 1 - share
        else:
            of = levels[depth - d + 1][1]
            mixed, left = mixed[of] + left[of] * share * kt, left[of] * (1 - share)
        low = pa.array(np.full(len(nodes), d > 2))
        sums = [pa.array(v, mask=low.to_numpy(zero_copy_only=False)) for v in (zeros, ones, weight)]
        out.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), d, np.int32)), pa.array(nodes.astype(np.int64)),
                                               pa.array(mixed + left / 2), *sums], names=["depth", "node", "q", "zeros", "ones", "weight"]))
    return out


def _build(depth: int, size: int = 1 << 18):
    """``_pair_trees`` of (pair, gram, n) sorted by pair, about ``size`` grams at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "gram", "n")]))
            if sum(h.shape[1] for h in held) > size:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0, -1]))  # the last pair may go on
                if cut:
                    yield from _pair_trees(rows[1, :cut].astype(np.uint64), rows[2, :cut], depth)
                held = [rows[:, cut:]]
        if held and held[0].size + sum(h.size for h in held[1:]):
            rows = np.concatenate(held, axis=1)
            yield from _pair_trees(rows[1].astype(np.uint64), rows[2], depth)
    return run


class Model:
    """The weighted trees. ``nodes``: a table (depth, node, q) of all nodes
    with two bytes of context or more. The others, at most 257 * 255, are here:
    ``mixed`` and ``left`` per byte and known bits, and ``low``, the sorted
    nodes and p of depths 0 and 1. ``node`` is the context, its nearest byte
    lowest, then eight bits: a one and the known bits of the byte."""

    def __init__(self, grams: DataFrame, depth: int = DEPTH):
        if not 2 <= depth <= 5:
            raise ValueError("contexts have two to five bytes")
        parts = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = grams.where("n > 0").select(F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)).alias("pair"), "gram", "n")
        built = staged(pairs.repartition(parts, "pair").sortWithinPartitions("pair").mapInArrow(
            _build(depth), "depth int, node long, q double, zeros double, ones double, weight double"), "trees")
        self.depth, self.nodes = depth, built.select("depth", "node", "q")
        two = built.where("depth = 2").groupBy(F.col("node").bitwiseAND(F.lit(0xFFFF)).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weight").alias("weight")).toArrow()
        node, zeros, ones, weight = (two.column(c).to_numpy() for c in ("node", "zeros", "ones", "weight"))
        first = _level(node.astype(np.uint64), zeros, ones, weight)
        root = _level(first[0] & np.uint64(255), first[2], first[3], first[6])
        r_mixed, r_left = root[5] * root[4], 1 - root[5]
        mixed, left = r_mixed[root[1]] + r_left[root[1]] * first[5] * first[4], r_left[root[1]] * (1 - first[5])
        self.mixed, self.left = np.zeros(1 << 16), np.ones(1 << 16)
        at = first[0].astype(np.int64)
        self.mixed[at], self.left[at] = mixed, left
        self.low = [(root[0], r_mixed + r_left / 2), (first[0], mixed + left / 2)]

    def blocks(self, block_nodes: int = BLOCK_NODES) -> list[tuple[int, int]]:
        """Ranges of pairs of last bytes whose nodes are few enough to send to every task."""
        pair = F.shiftright("node", 8).bitwiseAND(F.lit(0xFFFF))
        size = np.zeros(1 << 16, np.int64)
        for r in self.nodes.groupBy(pair.alias("pair")).count().collect():  # at most 65,536 rows
            size[r["pair"]] = r["count"]
        of = (np.cumsum(size) - size) // max(block_nodes, 1)
        starts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
        return list(zip(starts, [*starts[1:], 1 << 16]))

    def block(self, lo: int, hi: int) -> Trees:
        pair = F.shiftright("node", 8).bitwiseAND(F.lit(0xFFFF))
        part = self.nodes if hi - lo == 1 << 16 else self.nodes.where(pair.between(lo, hi - 1))
        trees = Trees(self, lo, hi)
        for d in range(2, self.depth + 1):
            trees.add(self, part.where(F.col("depth") == d).select("node", "q").toArrow())
        trees.spell_out()
        return trees


def _packed(p: np.ndarray) -> np.ndarray:
    """p of a one in single width: the less likely bit's probability, negative
    if that bit is zero."""
    return np.where(p <= 0.5, p, p - 1).astype(np.float32)


class Trees:
    """A block of nodes, to look up in: the sorted nodes and their packed p per
    depth, for contexts whose last two bytes lie in the block's range."""

    def __init__(self, model: Model, lo: int, hi: int):
        self.lo, self.hi, self.levels = lo, hi, [(nodes, _packed(p)) for nodes, p in model.low]
        self.grams, self.logs = np.empty(0, np.uint64), np.empty(0, np.float32)

    def add(self, model: Model, table: pa.Table) -> None:
        """The nodes of the next depth."""
        node, q = table.column("node").to_numpy(), table.column("q").to_numpy()
        order = np.argsort(node)
        near = node & 0xFFFF
        self.levels.append((node[order].astype(np.uint64), _packed(model.mixed[near] + model.left[near] * q)[order]))

    def spell_out(self, size: int = 1 << 18) -> None:
        """``log10_p`` of every gram whose bits, but for the last, training saw
        after the full context: what most bytes of a text ask for."""
        nodes = self.levels[-1][0]
        nodes = nodes[nodes & np.uint64(128) > 0]  # seven known bits
        stem = nodes & ~np.uint64(255) | (nodes & np.uint64(127)) << np.uint64(1)
        grams = np.stack([stem, stem | np.uint64(1)], axis=1).ravel()
        grams.sort()
        self.logs = np.concatenate([np.empty(0, np.float32), *[
            self._by_bits(grams[at:at + size]).astype(np.float32) for at in range(0, len(grams), size)]])
        self.grams = grams

    def holds(self, gram: np.ndarray) -> np.ndarray:
        """Does the block answer for the last two context bytes of ``gram``?"""
        pair = gram >> np.uint64(8) & np.uint64(0xFFFF)
        return (pair >= self.lo) & (pair < self.hi)

    def log10_p(self, gram: np.ndarray) -> np.ndarray:
        """log10 P(byte | context) of every gram."""
        if not len(self.grams):
            return self._by_bits(gram)
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        out, other = self.logs[at].astype(np.float64), self.grams[at] != gram
        out[other] = self._by_bits(gram[other])
        return out

    def _by_bits(self, gram: np.ndarray) -> np.ndarray:
        """The same bit by bit: p of the longest context that training saw
        before it; 1/2 if it saw none."""
        total, byte = np.zeros(len(gram)), gram & np.uint64(255)
        for j in range(8):
            node = gram & ~np.uint64(255) | (byte | np.uint64(256)) >> np.uint64(8 - j)
            p, todo = np.full(len(gram), 0.5, np.float32), np.arange(len(gram))
            for d in range(len(self.levels) - 1, -1, -1):
                nodes, ps = self.levels[d]
                if not len(nodes) or not len(todo):
                    continue
                want = node[todo] & np.uint64((1 << 8 * (d + 1)) - 1)
                at = np.minimum(np.searchsorted(nodes, want), len(nodes) - 1)
                hit = nodes[at] == want
                p[todo[hit]] = ps[at[hit]]
                todo = todo[~hit]
            one = (byte >> np.uint64(7 - j) & np.uint64(1)).astype(bool)
            rare = np.abs(p.astype(np.float64))
            total += np.log10(np.where((p > 0) == one, rare, 1 - rare))
        return total


# ---------------------------------------------------------------- scores
def _scores(trees: Trees, part: Slice) -> np.ndarray:
    """What the block's grams add to the score of each text."""
    score = np.zeros(part.n)
    for gram, text in part.grams():
        mine = trees.holds(gram)
        if not mine.all():
            gram, text = gram[mine], text[mine]
        key = gram << np.uint64(16) | text.astype(np.uint64)  # sorted: grams, and in them texts
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        times, key = np.diff(np.append(first, len(key))), key[first]
        gram = key >> np.uint64(16)
        change = np.append(True, gram[1:] != gram[:-1]) if len(gram) else np.empty(0, bool)
        logs = trees.log10_p(gram[change])[np.cumsum(change) - 1]
        score += np.bincount((key & np.uint64(0xFFFF)).astype(np.int64), weights=times * logs, minlength=part.n)
    return score


def _more_scores(trees):
    """(row, score) of a further block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(at, part.n), pa.array(_scores(trees.value, part))], names=["row", "score"])
    return run


def _texts(trees, hot, keep: list[str]):
    """(…, score, n_bytes, n_tokens, known, logs, words, counts): the first
    block's score, how many words of a text are frequent ones that training
    knows, the frequent words' sum of log10(c + 1), and the other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_list, hot_n = hot.value
        hot_words, hot_log, hot_seen = pa.array(hot_list, pa.string()), np.log10(hot_n + 1.0), (hot_n > 0).astype(np.float64)
        for batch in batches:
            for at, part in slices(batch.column("text")):
                coded = part.words.dictionary_encode()
                code, kinds, text = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.string()), part.word_text
                place = np.full(len(code), -1)
                if len(hot_list) and len(code):
                    place = pc.fill_null(pc.index_in(kinds, value_set=hot_words), -1).to_numpy(zero_copy_only=False)[code]
                known = place >= 0
                logs, n_known = (np.bincount(text[known], weights=v[place[known]] if len(v) else None, minlength=part.n).astype(np.float64)
                                 for v in (hot_log, hot_seen))
                k = max(len(kinds), 1)
                pairs, n = np.unique(text[~known] * k + code[~known], return_counts=True)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(pairs // k, minlength=part.n))]).astype(np.int32))
                score = _scores(trees.value, part)
                columns = [batch.column(c).slice(at, part.n) for c in keep] + [
                    pa.array(score), pa.array(part.n_bytes), pa.array(part.n_words + 1), pa.array(n_known.astype(np.int64)),
                    pa.array(logs), pa.ListArray.from_arrays(ends, kinds.take(pa.array(pairs % k))),
                    pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "n_bytes", "n_tokens", "known", "logs", "words", "counts"])
    return run


def language_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    block_nodes: int = BLOCK_NODES, hot_share: float = HOT_SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, and bits_per_byte, the tree's code length.

    A NULL text is empty: its only token is the end. A NULL id is learnt from.
    Repeated rows count, and are scored, each time. Texts of any length are
    read whole. An empty table gives no rows; with nothing to learn from, every
    bit has probability 1/2 and every token's base probability is one. Other
    columns, whatever their names, are left out.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    read = read.withColumn("held", held_out_of_language(F.col("doc_id")))
    grams = read.where(~F.col("held")).select("text").mapInArrow(_gram_counts, "gram long, n long")
    model = Model(grams.groupBy("gram").agg(F.sum("n").alias("n")))
    words = read.select("text", "held").mapInArrow(_word_counts, "word string, n long, n_train long")
    words = staged(words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")), "words")
    seen = words.agg(F.sum("n").alias("n"), F.sum("n_train").alias("t"), F.count_if(F.col("n_train") > 0).alias("v")).first()
    ends = read.where(~F.col("held")).count()
    train, kinds = (seen["t"] or 0) + ends, (seen["v"] or 0) + bool(ends)
    is_hot = (F.col("n") >= F.lit((seen["n"] or 0) * hot_share)) & (F.octet_length("word") <= HOT_WORD_BYTES)
    hot = words.where(is_hot).toArrow()  # at most 1 / hot_share rows
    hot = spark.sparkContext.broadcast((hot.column("word").to_pylist(), hot.column("n_train").to_numpy().astype(np.float64)))

    blocks, send = model.blocks(block_nodes), spark.sparkContext.broadcast
    if len(blocks) > 1:  # several passes over the texts need their rows to have names
        read = staged(read.withColumn("row", F.monotonically_increasing_id()), "rows")
    keep = [c for c in read.columns if c != "text"]
    kinds_of = ", ".join(f"{c} {read.schema[c].dataType.simpleString()}" for c in keep)
    scored = read.mapInArrow(_texts(send(model.block(*blocks[0])), hot, keep), f"{kinds_of}, score double, n_bytes long, n_tokens long, "
                             "known long, logs double, words array<string>, counts array<long>")
    if len(blocks) == 1:
        scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "texts")
    else:
        scored, more = staged(scored, "texts"), None
        for lo, hi in blocks[1:]:
            part = staged(read.select("row", "text").mapInArrow(_more_scores(send(model.block(lo, hi))), "row long, score double"), "scores")
            more = part if more is None else more.unionByName(part)
        more = more.groupBy("row").agg(F.sum("score").alias("more"))
        scored = scored.join(more, "row").withColumn("score", F.col("score") + F.col("more")).drop("more")

    rare = scored.where(F.size("words") > 0).select("row", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    rare = rare.select("row", F.col("w.words").alias("word"), F.col("w.counts").alias("times"))
    rare = rare.join(words.where(~is_hot & (F.col("n_train") > 0)).select("word", "n_train"), "word")
    rare = rare.groupBy("row").agg(F.sum("times").alias("rare"), F.sum(F.col("times") * F.log10(F.col("n_train") + 1)).alias("rare_logs"))
    out = scored.drop("words", "counts").join(rare, "row", "left")
    total = math.log10(train + kinds + 1)
    base = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + math.log10(ends + 1) - F.col("n_tokens") * F.lit(total)
    return out.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare", F.lit(0)) + int(bool(ends))).cast("long").alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (F.col("score") * F.lit(-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
