"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are read in a fixed pseudo-random order, over and over,
in blocks of ``block_rows``. Time is a row of slots, one block each. Block i of
a source with weight w is released at slot floor(i / w) and due before slot
ceil((i + 1) / w); among the released blocks the one due first goes next. Such
a schedule meets every due time, so at any slot each source has had its weight
times the slots so far, give or take less than one block.

Weights are exact: the schedule is worked out slot by slot for the whole mixture
and never rounded or repeated, so the deviation does not grow with the corpus.
One task does so, in memory that follows the number of sources, and writes the
schedule as a narrow table with one row a block.

Nothing is dropped. The mixture ends with the first slot at which every source
has been read to its end; sources that end before start again (``epoch``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, staged

BLOCK_ROWS = 64
#: Without target weights, a source's weight is its row count to this power.
TEMPERATURE = 0.7
#: More sources than this are an error: the scheduler holds them all.
MAX_SOURCES = 65536
#: A source is numbered in parts of about PART_ROWS rows, at most MAX_PARTS.
PART_ROWS = 500
MAX_PARTS = 65536
#: Rows of the schedule written at a time.
BATCH_SLOTS = 65536


def whole_shares(weights: Sequence[float], frame: int) -> list[int]:
    """Blocks of each source in a frame: one at least, ``frame`` in all, by
    largest remainder."""
    spare = frame - len(weights)
    exact = [w / sum(weights) * spare for w in weights]
    shares = [1 + int(x) for x in exact]
    order = sorted(range(len(weights)), key=lambda k: (int(exact[k]) - exact[k], k))
    for k in order[:frame - sum(shares)]:
        shares[k] += 1
    return shares


def exact_weights(weights: Sequence[float]) -> list[int]:
    """Whole numbers in exactly the ratios of ``weights``."""
    exact = [Fraction(w) for w in weights]
    scale = lcm(*[x.denominator for x in exact])
    return [int(x * scale) for x in exact]


def schedule(weights: Sequence[int]) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot, without end: earliest due first among the
    released blocks, ties to the first source."""
    total = sum(weights)
    waiting = [(0, k, 0) for k in range(len(weights))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[k]), k, i))
        _, k, i = heapq.heappop(ready)
        yield k, i
        heapq.heappush(waiting, ((i + 1) * total // weights[k], k, i + 1))
        t += 1


def schedule_until_read(weights: Sequence[int], blocks: Sequence[int]) -> Iterator[tuple[int, int]]:
    """``schedule`` up to the slot at which every source k has had ``blocks[k]``."""
    unread = len(blocks)
    for k, i in schedule(weights):
        yield k, i
        unread -= i + 1 == blocks[k]
        if not unread:
            return


def frame_schedule(shares: Sequence[int]) -> list[int]:
    """The source of each of the first sum(shares) slots."""
    return [k for k, _ in islice(schedule(shares), sum(shares))]


def _row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (map columns, which have no hash, aside)."""
    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if plain(f.dataType)] or [F.lit(0)])


def mix(docs: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None,
        temperature: float = TEMPERATURE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The mixture: the rows of ``docs`` with ``epoch`` (0 for the first
    reading of its source), ``block`` (of the source), ``slot`` and ``mix_row``
    (its place in the whole mixture). A row comes as often as its source is
    read, at least once. Should ``docs`` have columns of these names, the new
    ones get a trailing underscore.

    NULL is a source of its own. ``weights`` must name every source that
    occurs; others are ignored. Repeated rows are separate rows. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sorted(((r["source"], r["n"]) for r in sizes.limit(MAX_SOURCES + 1).collect()),
                   key=lambda x: (x[0] is not None, str(x[0])))
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is not None and (missing := [s for s, _ in sizes if not weights.get(s, 0) > 0]):
        raise ValueError(f"no weight for sources {missing[:5]}")
    names = {}
    for c in ("epoch", "block", "slot", "mix_row"):
        names[c] = fresh(docs, c)
    if not sizes:
        return docs.select("*", *[F.lit(0).cast("long").alias(n) for n in names.values()]).limit(0)

    exact = exact_weights([weights[s] if weights is not None else n ** temperature for s, n in sizes])
    blocks = [-(-n // block_rows) for _, n in sizes]

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                turns, at = schedule_until_read(exact, blocks), 0
                while some := list(islice(turns, BATCH_SLOTS)):
                    k, b = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k, pa.int32()), pa.array(b, pa.int64()), pa.array(range(at, at + len(some)), pa.int64())],
                        names=["k", "b", "slot"])
                    at += len(some)

    turns = staged(spark.range(0, 1, 1, 1).mapInArrow(slots, "k int, b long, slot long"), "mix-schedule")
    taken = {r["k"]: r["n"] for r in turns.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most MAX_SOURCES rows
    about = F.broadcast(spark.createDataFrame(
        [(k, s, n, taken[k] * block_rows, min(MAX_PARTS, -(-n // PART_ROWS)))
         for k, (s, n) in enumerate(sizes)],
        T.StructType([T.StructField("k", T.IntegerType()),
                      T.StructField("name", docs.schema[source].dataType)]
                     + [T.StructField(c, T.LongType()) for c in ("n", "rows", "parts")])))

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(f"`{source}`").alias("of"), _row_hash(docs).alias("h"))
    rows = rows.join(about, F.col("of").eqNullSafe(F.col("name"))).withColumn(
        "part", F.pmod(F.col("h"), F.col("parts")))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("k", "part").agg(F.count(F.lit(1)).alias("size")).select(
        "k", "part", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))

    def epochs(i: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.ceil((F.col("rows") - i) / F.col("n")) - 1)

    def block_of(i: Column) -> Column:
        return F.floor((i + F.col("e") * F.col("n")) / block_rows)
    # the slots of each part's blocks, epoch by epoch, travel with its start: rows are not shuffled for them
    first, last = block_of(F.col("start")), block_of(F.col("start") + F.col("size") - 1)
    read = starts.join(about, "k").where("start < rows").withColumn("e", F.explode(epochs(F.col("start"))))
    read = read.select("k", "part", "start", "e", F.explode(F.sequence(first, last)).alias("b"))
    read = read.join(turns, ["k", "b"]).groupBy("k", "part", "start", "e").agg(
        F.sort_array(F.collect_list("slot")).alias("slots"))
    starts = read.groupBy("k", "part", "start").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("e", "slots"))), lambda x: x["slots"]).alias("slots"))
    rows = rows.join(starts, ["k", "part"]).withColumn(
        "i", F.col("start") + F.row_number().over(Window.partitionBy("k", "part").orderBy("h")) - 1)
    rows = rows.where("i < rows").withColumn("e", F.explode(epochs(F.col("i"))))
    rows = rows.withColumn("p", F.col("i") + F.col("e") * F.col("n")).withColumn("b", F.floor(F.col("p") / block_rows))
    slot = F.get(F.get(F.col("slots"), F.col("e").cast("int")), (F.col("b") - block_of(F.col("start"))).cast("int"))
    rows = rows.withColumn("slot", slot)
    return rows.select("row.*", F.col("e").alias(names["epoch"]), F.col("b").alias(names["block"]),
                       F.col("slot").alias(names["slot"]),
                       (F.col("slot") * block_rows + F.col("p") % block_rows).alias(names["mix_row"]))


def mixed_documents(docs: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None,
                    temperature: float = TEMPERATURE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The mixture with the columns of ``docs`` only: every row as often as
    the target weights call for."""
    mixed = mix(docs, source, weights, temperature, block_rows)
    return mixed.drop(*mixed.columns[len(docs.columns):])
