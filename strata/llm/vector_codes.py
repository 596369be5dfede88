"""Vectors compressed to one codebook entry per part, by k-means whose passes
skip distances with adaptive bounds (Drake and Hamerly).

A vector's components become integers, floor(SCALE * x), cut into ``PARTS``
equal parts; each part position has a codebook of up to ``ENTRIES`` entries.
The first pass measures every distance. Per part it keeps its entry, the b
closest other entries in order with a lower bound of each one's distance, and
one outer bound for all entries beyond them. When the entries move, the bounds
shrink by as much. In a later pass a part whose own new distance stays below all
its bounds keeps its entry with that one distance; else the listed entries are
measured, and all entries only if the outer bound lets one in. Bounds are
half-width floats rounded down; whatever they leave open, equal distances
included, is decided by integers, so the codes are those of plain k-means.

b starts at an eighth of the entries. After each pass it shrinks to what its
lists needed, or doubles if too many parts had to measure everything.

Each pass is one scan that writes the vectors with their bounds for the next to
the shared folder. Entries are updated from exact integer sums per entry and
component; the codebooks, of fixed size, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Share of parts that may measure every entry before b doubles.
FULL_SHARE = 0.1
#: Greater components count as this: squared distances must fit 64 bits.
LARGEST = 1 << 22
#: Labels whose totals are sent to every task; more are joined by a shuffle.
MAX_LABELS = 1 << 16
_NONE = 255  # no entry at this place of a list
_ROWS = 4096


def _distances(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, k) of the rows of ``x`` to those of ``books``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(books).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < 1 << 52:  # every step is exact in double
        xf, cf = x.astype(np.float64), books.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(books)), np.int64)
    for k, entry in enumerate(books):
        out[:, k] = ((x - entry) ** 2).sum(1)
    return out


def _above(squared: np.ndarray) -> np.ndarray:
    """Distances not below the true ones."""
    return np.sqrt(squared.astype(np.float64)) * (1 + 1e-9) + 1e-9


def _below(values: np.ndarray) -> np.ndarray:
    """Half-width floats not above ``values`` (0 or more)."""
    top = np.minimum(values, 65504.0)
    half = top.astype(np.float16)
    return np.where(half > top, np.nextafter(half, np.float16(0)), half)


def _listed(d: np.ndarray, own: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries, bounds, outer): the b closest entries but the own one, in
    order, and the distance that all others have at least."""
    n, k = d.shape
    d = np.sqrt(d.astype(np.float64))
    d[np.arange(n), own] = np.inf
    reach = min(b + 1, k)
    near = np.argpartition(d, reach - 1, axis=1)[:, :reach] if reach < k else np.tile(np.arange(k), (n, 1))
    near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1), 1)
    dist = np.take_along_axis(d, near, 1)
    entries, bounds = np.full((n, b), _NONE, np.uint8), np.full((n, b), np.inf)
    have = min(b, reach)
    entries[:, :have] = np.where(np.isfinite(dist[:, :have]), near[:, :have], _NONE)
    bounds[:, :have] = dist[:, :have]
    outer = dist[:, b] if reach > b else np.full(n, np.inf)
    return entries, bounds, outer


class Pass:
    """One pass over the parts of some vectors. ``moved`` (per part and entry,
    how far it went) is None in the first pass; ``b`` is the list length to
    keep. ``full`` and ``need`` say, per vector, how many parts measured every
    entry and the longest list that another part had to look at."""

    def __init__(self, books: np.ndarray, b: int, moved: np.ndarray | None):
        self.books, self.b, self.moved = books, b, moved

    def first(self, p: int, x: np.ndarray):
        d = _distances(x, self.books[p])
        own = d.argmin(1)
        kept = _listed(d, own, self.b)
        return own, d[np.arange(len(x)), own], *kept, np.ones(len(x), bool), np.zeros(len(x), np.int64)

    def again(self, p: int, x: np.ndarray, own: np.ndarray, entries: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
        """(own, squared distance, entries, bounds, outer, full, need) of each
        part, from what the pass before kept."""
        books, moved, n = self.books[p], self.moved[p], len(x)
        own, width = own.astype(np.int64), max(self.b, entries.shape[1])
        pad = ((0, 0), (0, width - entries.shape[1]))
        entries = np.pad(entries, pad, constant_values=_NONE)
        bounds = np.pad(bounds.astype(np.float64), pad, constant_values=np.inf)
        known = entries != _NONE
        bounds = np.where(known, np.maximum(bounds - moved[np.where(known, entries, 0)], 0), np.inf)
        outer = np.maximum(outer - moved.max(initial=0.0), 0)
        best = ((x - books[own]) ** 2).sum(1)
        close = bounds <= _above(best)[:, None]
        full, need = np.zeros(n, bool), close.sum(1)
        rows = np.flatnonzero(close.any(1) | (outer <= _above(best)))
        if len(rows):  # measure the own entry and the listed ones; equal distances go to the lower index
            named = np.concatenate([own[rows, None], entries[rows].astype(np.int64)], axis=1)
            there = named != _NONE
            d = np.where(there, ((x[rows, None, :] - books[np.where(there, named, 0)]) ** 2).sum(2), np.iinfo(np.int64).max)
            least = d.min(1)
            pick = np.where(d == least[:, None], named, _NONE).min(1)
            rest = named != pick[:, None]  # drops one column: the new own entry
            named, there, d = (v[rest].reshape(len(rows), width) for v in (named, there, d))
            own[rows], best[rows], entries[rows] = pick, least, named
            bounds[rows] = np.where(there, np.sqrt(d.astype(np.float64)), np.inf)
            full[rows] = outer[rows] <= _above(least)
            all_ = np.flatnonzero(full)
            d = _distances(x[all_], books)
            own[all_] = d.argmin(1)
            best[all_] = d[np.arange(len(all_)), own[all_]]
            entries[all_], bounds[all_], outer[all_] = _listed(d, own[all_], width)
        order = np.argsort(bounds, axis=1, kind="stable")
        entries, bounds = np.take_along_axis(entries, order, 1), np.take_along_axis(bounds, order, 1)
        outer = np.minimum(outer, bounds[:, self.b:].min(axis=1, initial=np.inf))
        return own, best, entries[:, :self.b], bounds[:, :self.b], outer, full, np.where(full, 0, need)

    def vectors(self, x: np.ndarray, kept: tuple | None):
        """The same for all parts of the vectors ``x`` (n, parts, width)."""
        parts = [self.first(p, x[:, p]) if kept is None else self.again(p, x[:, p], *[k[:, p] for k in kept]) for p in range(x.shape[1])]
        return [np.stack(c, axis=1) for c in zip(*parts)]


# ---------------------------------------------------------------- passes
def _matrix(column: pa.Array, dtype, *shape: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype)
    return flat.reshape(len(column), *shape)


def _binary(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(matrix)], pa.binary())


def _vectors(batch: pa.RecordBatch, dtype, width: int, old_b: int | None):
    x = _matrix(batch.column("__x"), dtype, PARTS, width).astype(np.int64)
    if old_b is None:
        return x, None
    near = _matrix(batch.column("__near"), np.uint8, PARTS, old_b)
    bounds = _matrix(batch.column("__bounds"), np.float16, PARTS, old_b + 1).astype(np.float64)
    bounds[bounds >= 65504.0] = 65504.0
    return x, (_matrix(batch.column("__own"), np.uint8, PARTS), near, bounds[:, :, :old_b], bounds[:, :, old_b])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _pack(dtype, size: int):
    """Components as one binary value, filled up with zeros to ``size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            lists = batch.column("__x")
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.zeros((batch.num_rows, size), dtype)
            row = np.repeat(np.arange(batch.num_rows), length)
            x[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(x)], names=["vec_id", "label", "__x"])
    return run


def _assign(books, b, moved, old_b, dtype, width):
    """A pass that keeps its bounds for the next."""
    step = Pass(books, b, moved)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            own, _, near, bounds, outer, full, need = step.vectors(*_vectors(batch, dtype, width, old_b))
            kept = np.concatenate([_below(bounds), _below(outer)[:, :, None]], axis=2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("__x"), _binary(own.astype(np.uint8)), _binary(near),
                 _binary(kept), pa.array(full.sum(1).astype(np.int32)), pa.array(need.max(1).astype(np.int32))],
                names=["vec_id", "label", "__x", "__own", "__near", "__bounds", "__full", "__need"])
    return run


def _last(books, moved, old_b, dtype, width):
    """The final pass: codes and errors."""
    step = Pass(books, 0, moved)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches):
            own, best, *_ = step.vectors(*_vectors(batch, dtype, width, old_b))
            code = [row.tobytes().hex() for row in own.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(best.sum(1))],
                                             names=["vec_id", "label", "code", "error"])
    return run


def _sums(dtype, width: int, k: int):
    """(part, entry, place, total, n): a task's sums per component of each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((PARTS, k, width), np.int64), np.zeros((PARTS, k), np.int64)
        for batch in _rows(batches):
            x = _matrix(batch.column("__x"), dtype, PARTS, width).astype(np.int64)
            own = _matrix(batch.column("__own"), np.uint8, PARTS)
            for p in range(PARTS):
                np.add.at(total[p], own[:, p], x[:, p])
                n[p] += np.bincount(own[:, p], minlength=k)
        part, entry, place = (v.ravel() for v in np.indices(total.shape))
        used = n[part, entry] > 0
        yield pa.RecordBatch.from_arrays([pa.array(v[used]) for v in (part, entry, place, total.ravel(), n[part, entry])],
                                         names=["part", "entry", "place", "total", "n"])
    return run


def updated(books: np.ndarray, state: DataFrame, dtype) -> np.ndarray:
    """Each entry as floor(sum / count) of its parts; unused ones stay."""
    parts, k, width = books.shape
    sums = state.select("__x", "__own").mapInArrow(_sums(dtype, width, k), "part long, entry long, place long, total long, n long")
    out = books.copy()
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("t"), F.sum("n").alias("n")).collect():  # a codebook's size
        out[r["part"], r["entry"], r["place"]] = r["t"] // r["n"]
    return out


def next_length(b: int, k: int, full_share: float, need: int) -> int:
    """The list length after a pass: twice as long if too many parts measured
    every entry, else what its lists needed, between an eighth of that and
    all."""
    if full_share > FULL_SHARE:
        return min(2 * b, max(k - 1, 1))
    return max(min(need, b), -(-b // 8), 1)


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of each vector.

    Rows whose vector is NULL or has NULL or non-finite components are left
    out. Vectors shorter than the longest (rounded up to a multiple of
    ``PARTS``) are filled up with zeros; components beyond LARGEST count as
    LARGEST. A codebook starts as the vectors with the ``entries`` smallest
    distinct ids (of rows with one id, the least vector); a NULL id starts
    none but is coded. With no id at all, codes are empty and errors NULL.
    Repeated rows count, and are coded, each time; NULL labels are one label.
    An empty table gives no rows. Other columns, whatever their names, are
    left out."""
    spark = vectors.sparkSession
    if not 1 <= entries < _NONE:
        raise ValueError(f"entries must be 1 to {_NONE - 1}")
    x = F.col(f"`{embedding}`")
    kept = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), x.cast("array<double>").alias("__x"))
    kept = kept.where(F.col("__x").isNotNull() & F.forall("__x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    limit = float(LARGEST)
    kept = kept.withColumn("__x", F.transform("__x", lambda v: F.least(F.greatest(F.floor(F.least(F.greatest(
        v * SCALE, F.lit(-2 * limit)), F.lit(2 * limit))), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")))
    about = kept.agg(F.max(F.size("__x")).alias("size"), F.max(F.array_max(F.transform("__x", F.abs))).alias("most")).first()
    width = -(-(about["size"] or 0) // PARTS)
    dtype = np.int16 if (about["most"] or 0) < 1 << 15 else np.int32
    seeds = [r[0] for r in kept.select("vec_id").where("vec_id is not null").distinct().orderBy("vec_id").limit(entries).collect()]
    seeded = kept.where(F.col("vec_id").isin(seeds)).groupBy("vec_id").agg(F.min("__x").alias("x")).collect() if seeds else []
    first = np.zeros((len(seeded), PARTS * width), np.int64)
    for k, r in enumerate(sorted(seeded, key=lambda r: r["vec_id"])):
        first[k, :len(r["x"])] = r["x"]
    books = np.ascontiguousarray(first.reshape(len(first), PARTS, width).transpose(1, 0, 2))
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    if not len(seeded):
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(None).cast("long").alias("error"),
                           F.lit(None).cast("long").alias("label_error"), F.lit(_digest(books)).alias("codebooks_sha256"))

    head = f"vec_id {id_type}, label {label_type}"
    state = kept.mapInArrow(_pack(dtype, PARTS * width), f"{head}, __x binary")
    k, b, old_b, moved = len(seeded), max(1, len(seeded) // 8), None, None
    for _ in range(rounds):
        state = staged(state.mapInArrow(_assign(books, b, moved, old_b, dtype, width),
                                        f"{head}, __x binary, __own binary, __near binary, __bounds binary, __full int, __need int"), "codes")
        old_b = b
        new = updated(books, state, dtype)
        if moved is not None:  # the first pass measures everything and says nothing about lists
            seen = state.agg(F.sum("__full").alias("full"), F.max("__need").alias("need"), F.count(F.lit(1)).alias("n")).first()
            b = next_length(b, k, seen["full"] / (seen["n"] * PARTS), seen["need"])
        moved = np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)) * (1 + 1e-9)
        books = new
    coded = staged(state.mapInArrow(_last(books, moved, old_b, dtype, width), f"{head}, code string, error long"), "coded")
    most = F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    totals = coded.groupBy(F.col("label").alias("__label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    totals = staged(totals, "label-errors")
    if totals.count() <= MAX_LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(_digest(books)).alias("codebooks_sha256"))


def _digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
