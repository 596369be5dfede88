"""Sinks: append / full refresh, calendar partitions, schema evolution,
compaction and clustered rewrites on plain parquet catalog tables.

Every write goes through one check (``fit``): new columns, also inside
structs, are added to the table or refused; a type that could lose values
raises; nothing is dropped or turned into NULL. Schemas merge in every mode,
so an overwrite keeps the table's other columns (as NULL).

Rewrites (full refresh, compaction, clustering, new fields inside a struct)
never overwrite a table while reading it: the new content is written to a
staging table, and from there over the table. A failed rewrite raises and
leaves the staging table, whose name the error gives.
"""

from __future__ import annotations

import contextlib
import logging
import math
import re
import threading
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, MapType, StructField,
                               StructType)

from strata.operators.joins import measure_small
from strata.session import scratch_path, shared_dir
from strata.sources.curve import curve_key

log = logging.getLogger(__name__)

DEFAULT_FILE_MB = 128
MAX_TASKS = 100_000


# ---------------------------------------------------------------- catalog
@dataclass(frozen=True)
class TableStore:
    """Where layered tables live: ``{prefix}_{layer}`` databases, each with its
    folder under ``root`` (shared storage)."""
    spark: SparkSession
    root: str
    prefix: str = "dev"

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def ensure_database(self, layer: str) -> str:
        db = self.database(layer)
        ensure_database(self.spark, db, f"{self.root.rstrip('/')}/{db}.db")
        return db

    def exists(self, layer: str, table: str) -> bool:
        return table_exists(self.spark, self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame | None:
        name = self.name(layer, table)
        return self.spark.table(name) if table_exists(self.spark, name) else None


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the target database if missing."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Does the target exist (first load vs increment)."""
    return spark.catalog.tableExists(name)


def load_kind(spark: SparkSession, name: str) -> str:
    return "increment" if table_exists(spark, name) else "first"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


# ---------------------------------------------------------------- audit
def with_audit(df: DataFrame, created: str | None = "created_date",
               updated: str | None = None, user: str | None = None) -> DataFrame:
    """Load time if absent; optional update time and user columns. The
    time is one constant per action (Catalyst folds ``current_timestamp``)."""
    cols = ["*"]
    if created and created not in df.columns:
        cols.append(F.current_timestamp().alias(created))
    if updated:
        cols.append(F.current_timestamp().alias(updated))
    if user:
        cols.append(F.current_user().alias(user))
    return df.select(*cols)


# ---------------------------------------------------------------- schema
class SchemaMismatch(ValueError):
    pass


# Decimal digits that hold every value of an integer type.
_DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}
_NESTED = (StructType, ArrayType, MapType)


def widens_to(src: DataType, tgt: DataType) -> bool:
    """Can every ``src`` value be stored as ``tgt`` without loss? Integers in
    wider integers, in decimals with room for their digits and, up to int, in
    double; decimals in decimals with as many digits on both sides; float in
    double; date in timestamps; plain values other than binary in string.
    Structs, arrays and maps: if their parts can; a struct may lack fields."""
    a, b = src.typeName(), tgt.typeName()
    if src == tgt or a == "void":
        return True
    if isinstance(src, StructType) and isinstance(tgt, StructType):
        have = {f.name.lower(): f.dataType for f in tgt}
        return all(f.name.lower() in have and widens_to(f.dataType, have[f.name.lower()]) for f in src)
    if isinstance(src, ArrayType) and isinstance(tgt, ArrayType):
        return widens_to(src.elementType, tgt.elementType)
    if isinstance(src, MapType) and isinstance(tgt, MapType):
        return widens_to(src.keyType, tgt.keyType) and widens_to(src.valueType, tgt.valueType)
    if isinstance(src, _NESTED) or isinstance(tgt, _NESTED):
        return False
    if b == "string":
        return a != "binary"
    if a in _DIGITS and b in _DIGITS:
        return _DIGITS[a] <= _DIGITS[b]
    if isinstance(tgt, DecimalType):
        if a in _DIGITS:
            return tgt.precision - tgt.scale >= _DIGITS[a]
        return (isinstance(src, DecimalType) and tgt.scale >= src.scale
                and tgt.precision - tgt.scale >= src.precision - src.scale)
    if b == "double":
        return a in ("byte", "short", "integer", "float")
    if b == "float":
        return a in ("byte", "short")
    return a == "date" and b in ("timestamp", "timestamp_ntz")


def merge_types(old: DataType, new: DataType, path: str) -> DataType:
    """``old`` with the struct fields that only ``new`` has. Raises if a value
    of ``new`` could be lost in it."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        theirs = {f.name.lower(): f for f in new}
        fields = [StructField(f.name, merge_types(f.dataType, theirs[f.name.lower()].dataType, f"{path}.{f.name}")
                              if f.name.lower() in theirs else f.dataType) for f in old]
        known = {f.name.lower() for f in old}
        return StructType(fields + [StructField(f.name, f.dataType) for f in new if f.name.lower() not in known])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merge_types(old.elementType, new.elementType, f"{path}[]"))
    if isinstance(old, MapType) and isinstance(new, MapType):
        return MapType(merge_types(old.keyType, new.keyType, f"{path}.key"),
                       merge_types(old.valueType, new.valueType, f"{path}.value"))
    if not widens_to(new, old):
        raise SchemaMismatch(f"{path}: {new.simpleString()} would lose values in {old.simpleString()}")
    return old


def _same(a: DataType, b: DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def _conform(c: Column, src: DataType, tgt: DataType) -> Column:
    """``c`` as ``tgt``, struct fields by name, missing ones NULL."""
    if _same(src, tgt):
        return c
    if isinstance(tgt, StructType):
        have = {f.name.lower(): f for f in src}
        fields = [(_conform(c[have[f.name.lower()].name], have[f.name.lower()].dataType, f.dataType)
                   if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in tgt]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(tgt, ArrayType):
        return F.transform(c, lambda x: _conform(x, src.elementType, tgt.elementType))
    if isinstance(tgt, MapType):
        return F.map_from_arrays(
            F.transform(F.map_keys(c), lambda x: _conform(x, src.keyType, tgt.keyType)),
            F.transform(F.map_values(c), lambda x: _conform(x, src.valueType, tgt.valueType)))
    return c.cast(tgt)


def align_to(df: DataFrame, target: StructType) -> DataFrame:
    """Frame with the target's columns, by name, in its types; missing ones
    are NULL. ``merge_types`` must have allowed it."""
    have = {f.name.lower(): f for f in df.schema}
    return df.select(*[
        (_conform(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType)
         if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])


def evolve_table(spark: SparkSession, name: str, df: DataFrame, evolve: bool = True) -> StructType:
    """Make the table hold every column and struct field of ``df``, and
    return its schema. New columns are added to the catalog entry; new struct
    fields need a rewrite. With ``evolve=False`` either raises, as does a
    type that would lose values."""
    old = spark.table(name).schema
    merged = merge_types(old, df.schema, name)
    known = {f.name.lower() for f in old}
    new = [f for f in merged if f.name.lower() not in known]
    deeper = [f.name for f, g in zip(old, merged) if not _same(f.dataType, g.dataType)]
    if (new or deeper) and not evolve:
        raise SchemaMismatch(f"{name} lacks {[f.name for f in new] + deeper}")
    if deeper:
        rewrite(spark, name, align_to(spark.table(name), merged))
    elif new:
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({spec})")
        spark.catalog.refreshTable(name)
    return spark.table(name).schema


# ---------------------------------------------------------------- writes
_OVERWRITING = threading.RLock()


@contextlib.contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """``insertInto`` takes the partition overwrite mode from the session, not
    from writer options: set it for one insert, then restore it. Loads that run
    at once share the session, so one overwrites at a time; appends, to which
    the mode is nothing, go on meanwhile."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _OVERWRITING:
        old = spark.conf.get(key, None)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


def write_table(df: DataFrame, name: str, mode: str = "append",
                partition_by: Sequence[str] = (), evolve: bool = True,
                created: str | None = "created_date", location: str | None = None,
                layout: bool = True) -> None:
    """Write ``df`` to catalog table ``name`` as parquet.

    ``append`` adds rows by column name. ``overwrite`` replaces the rows; on
    a partitioned table only the partitions present in ``df`` (dynamic
    partition overwrite). Either way the table first gets the columns and
    struct fields that only ``df`` has, and columns that ``df`` lacks are
    NULL. With ``evolve=False`` a new column raises ``SchemaMismatch``. So
    does, always, a type whose values would not all fit the table's.

    A partitioned write is first dealt out in the order of (partition columns,
    row hash) when ``layout`` is on: each partition value then lands in about
    one file instead of one file per writing task, and a hot value still
    spans several tasks.
    """
    spark = df.sparkSession
    db = name.split(".")[0] if "." in name else None
    if db:
        ensure_database(spark, db, location)
    if created:
        df = with_audit(df, created=created)
    if partition_by and layout:
        df = _layout_by_counts(df, int(spark.conf.get("spark.sql.shuffle.partitions")), partition_by)
    if not table_exists(spark, name):
        writer = df.write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    df = align_to(df, evolve_table(spark, name, df, evolve))
    if mode == "overwrite" and not partition_by:
        rewrite(spark, name, df)
        return
    # by position, in the table's order
    if mode != "overwrite":
        df.write.insertInto(name, overwrite=False)
        return
    with _overwrite_mode(spark, "dynamic"):
        df.write.insertInto(name, overwrite=True)


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                 evolve: bool = True, created: str | None = "created_date") -> None:
    write_table(df, name, "append", partition_by, evolve, created)


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                    created: str | None = "created_date", evolve: bool = True) -> None:
    """Full refresh of every row. The frame may read the table itself.
    Schemas merge as on any other write."""
    spark = df.sparkSession
    if created:
        df = with_audit(df, created=created)
    if not table_exists(spark, name):
        write_table(df, name, "append", partition_by, created=None)
        return
    old = spark.table(name).schema
    merged = merge_types(old, df.schema, name)
    if not evolve and not _same(old, merged):
        raise SchemaMismatch(f"{name} lacks fields of {df.schema.simpleString()}")
    rewrite(spark, name, align_to(df, merged), partition_by)


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Compute ``df`` once, into the shared scratch folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def moves_rows(df: DataFrame) -> bool:
    """Does ``df`` shuffle rows, so that reading it twice costs more than its files?"""
    return "hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def write_if_any(df: DataFrame, sink: Callable[[DataFrame], None], staged: bool = False) -> bool:
    """Skip the write when there is nothing to load. The frame is staged
    first, so the test, the layout and the write all read its rows instead
    of computing them again; not if it is ``staged``, a plain scan of rows
    that lie in files already."""
    held = df if staged else stage(df, "increment")
    if held.isEmpty():
        return False
    sink(held)
    return True


# ---------------------------------------------------------------- rewrites
def rewrite(spark: SparkSession, name: str, df: DataFrame, partition_by: Sequence[str] | None = None,
            layout: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace table ``name`` (rows and schema) by ``df``, which may read it.

    ``df`` is written to a staging table first; ``layout`` of that is written
    over the table. If the second step fails, the staging table stays and the
    error names it."""
    if partition_by is None:
        partition_by = partition_columns(spark, name)
    staging = f"{name}__staging_{uuid.uuid4().hex[:8]}"
    df.write.format("parquet").saveAsTable(staging)
    try:
        held = spark.table(staging)
        writer = (layout(held) if layout else held).write.format("parquet").mode("overwrite")
        with _overwrite_mode(spark, "static"):
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    except Exception as e:
        e.add_note(f"the new content of {name} is in {staging}")
        raise
    spark.sql(f"DROP TABLE {staging}")
    spark.catalog.refreshTable(name)


def table_bytes(spark: SparkSession, name: str) -> int:
    """Total file bytes of a table, from the catalog's statistics (``ANALYZE
    … NOSCAN`` reads file sizes only)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if r["col_name"] == "Statistics":
            m = re.match(r"\s*(\d+)\s+bytes", r["data_type"])
            if m:
                return int(m.group(1))
    return 0


def file_count(spark: SparkSession, name: str) -> int:
    return len(spark.table(name).inputFiles())


def _layout_by_counts(df: DataFrame, n: int, pcols: Sequence[str]) -> DataFrame:
    """``n`` pieces of equal size in the order of the partition columns, as
    range-partitioning makes them, for rows that are costly to read twice: that
    samples whole rows, here the rows of each partition value are counted, for
    which its columns are enough. A value that spans several pieces is dealt
    out by the row hash. More values than can be broadcast are range-partitioned.
    A row whose value was not counted (the source has changed) goes first."""
    spark = df.sparkSession
    shared_dir(spark)                                 # the checkpoint folder must be set
    marks = [f"__p{i}" for i in range(len(pcols))]
    per = (df.groupBy(*[F.col(f"`{c}`").alias(m) for c, m in zip(pcols, marks)]).agg(F.count(F.lit(1)).alias("__rows"))
           .checkpoint(eager=True))
    if not measure_small(per).small:
        return _layout(df, n, pcols, ())
    before = Window.orderBy(*marks).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("__rows").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    piece = lambda place: F.floor(place * n / F.col("__total")).cast("int")
    per = (per.select("*", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"), total.alias("__total"))
           .select(*marks, "__rows", "__start", "__total", piece(F.col("__start")).alias("__first"),
                   piece(F.col("__start") + F.col("__rows") - 1).alias("__last")))
    on = F.lit(True)
    for c, m in zip(pcols, marks):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(m))
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    place = F.col("__start") + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.col("__rows"))
    number = F.when(F.col("__first") == F.col("__last"), F.col("__first")).otherwise(piece(place))
    dealt = df.join(F.broadcast(per), on, "left").withColumn("__piece", F.least(F.coalesce(number, F.lit(0)), F.lit(n - 1)))
    return dealt.repartitionById(n, "__piece").select(*[F.col(f"`{c}`") for c in df.columns])


def _layout(df: DataFrame, n: int, pcols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-partition on (partition columns, order columns or a row hash):
    a hot partition value spans several tasks instead of one."""
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)] or df.columns[:1]
    keys = [F.col(c) for c in pcols] + ([F.col(c) for c in order] if order
                                        else [F.xxhash64(*[F.col(f"`{c}`") for c in hashable])])
    out = df.repartitionByRange(n, *keys)
    if order:
        out = out.sortWithinPartitions(*[F.col(c) for c in [*pcols, *order]])
    return out


def _curve_layout(df: DataFrame, n: int, pcols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Range-partition on (partition columns, place on the curve through
    ``cols``). The row hash comes last, so rows equal in ``cols`` may span
    several tasks."""
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    key = "__curve"
    while key in df.columns:
        key += "_"
    keys = [F.col(f"`{c}`") for c in [*pcols, key, *cols]]
    return (df.withColumn(key, curve_key(df, cols))
            .repartitionByRange(n, *keys, F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
            .sortWithinPartitions(*keys).drop(key))


@dataclass(frozen=True)
class RewriteStats:
    files_before: int
    files_after: int
    bytes: int
    partitions: int


def compact(spark: SparkSession, name: str, target_file_mb: float = DEFAULT_FILE_MB,
            order: Sequence[str] = ()) -> RewriteStats:
    """Rewrite the table into files of about ``target_file_mb``.

    The task count comes from the table's size; range partitioning over the
    partition columns plus a row hash keeps each task near the target even
    when one partition value holds most rows. With ``order``, files are narrow
    in these columns instead: sorted on a single one, along a space-filling
    curve through several."""
    before = file_count(spark, name)
    size = table_bytes(spark, name)
    n = max(1, math.ceil(size / (target_file_mb * 1024 * 1024)))
    pcols = partition_columns(spark, name)
    rewrite(spark, name, spark.table(name), pcols, layout=lambda d: _curve_layout(d, n, pcols, order) if len(order) > 1
            else _layout(d, n, pcols, order))
    return RewriteStats(before, file_count(spark, name), size, n)


# Fixed value: a file of this share of the target size or more is left as it is.
FULL_FILE = 0.75


def partition_files(spark: SparkSession, name: str) -> DataFrame:
    """(partition columns, file, bytes) of every data file of a table, from
    the files' own metadata; no column of the rows is read."""
    pcols = partition_columns(spark, name)
    return spark.table(name).select(
        *pcols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()


def partitions_to_compact(files: DataFrame, pcols: Sequence[str], target_file_mb: float = DEFAULT_FILE_MB,
                          min_saved: int = 1) -> DataFrame:
    """(partition columns, files, small, bytes, packed): the partitions whose
    small files would pack into at least ``min_saved`` fewer. ``packed`` is how
    many files of the target size the whole partition fills."""
    target = int(target_file_mb * 1024 * 1024)
    small = F.col("bytes") < int(target * FULL_FILE)
    per = files.groupBy(*pcols).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(small).alias("small"), F.sum("bytes").alias("bytes"),
        F.coalesce(F.sum(F.when(small, F.col("bytes"))), F.lit(0)).alias("small_bytes"))
    fewer = F.greatest(F.ceil(F.col("small_bytes") / target), F.lit(1))
    return per.where(F.col("small") - fewer >= min_saved).select(
        *pcols, "files", "small", "bytes", F.greatest(F.ceil(F.col("bytes") / target), F.lit(1)).cast("int").alias("packed"))


def compact_where_needed(spark: SparkSession, name: str, target_file_mb: float = DEFAULT_FILE_MB,
                         min_saved: int = 1) -> RewriteStats | None:
    """Compaction of what needs it. Partitions whose small files pack into
    fewer are rewritten, the others keep their files; an unpartitioned table is
    one partition. None if there is nothing to do.

    The chosen rows are staged, dealt over as many tasks as the packed files
    (a partition's rows by their hash, so a large one spans several tasks) and
    put in place by dynamic partition overwrite. As with every rewrite, if that
    fails the error names the staging table."""
    pcols = partition_columns(spark, name)
    chosen = partitions_to_compact(partition_files(spark, name), pcols, target_file_mb, min_saved)
    chosen = stage(chosen, "to-compact")
    total = chosen.agg(F.sum("packed").alias("n"), F.sum("bytes").alias("b"), F.sum("files").alias("f")).first()
    if not total["n"]:
        return None
    if not pcols:
        return compact(spark, name, max(1, int(target_file_mb)))
    before = file_count(spark, name)
    marks = chosen.select(*[F.col(f"`{c}`").alias(f"__p{i}") for i, c in enumerate(pcols)], "packed")
    on = F.lit(True)
    for i, c in enumerate(pcols):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"__p{i}"))
    table = spark.table(name)
    staging = f"{name}__staging_{uuid.uuid4().hex[:8]}"
    # as many rows as the table has partitions: broadcast only if that measures small
    side = marks.drop("packed")
    if measure_small(side).small:
        side = F.broadcast(side)
    table.join(side, on, "left_semi").write.format("parquet").saveAsTable(staging)
    try:
        held = spark.table(staging)
        hashable = [f.name for f in held.schema.fields if not isinstance(f.dataType, MapType)]
        wide = F.broadcast(marks) if measure_small(marks).small else marks
        tagged = held.join(wide, on).withColumn("__slice", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.col("packed")))
        dealt = tagged.repartition(min(int(total["n"]), MAX_TASKS), *[F.col(f"`{c}`") for c in pcols], "__slice")
        with _overwrite_mode(spark, "dynamic"):
            dealt.select(*[F.col(f"`{c}`") for c in table.columns]).write.insertInto(name, overwrite=True)
    except Exception as e:
        e.add_note(f"the rewritten partitions of {name} are in {staging}")
        raise
    spark.sql(f"DROP TABLE {staging}")
    spark.catalog.refreshTable(name)
    return RewriteStats(before, file_count(spark, name), int(total["b"]), chosen.count())


def cluster_rewrite(spark: SparkSession, name: str, cols: Sequence[str],
                    target_file_mb: float = DEFAULT_FILE_MB) -> RewriteStats | None:
    """Lay the table out so that each file covers a narrow range of every
    one of ``cols`` (``sources.curve``; sorted if there is only one). No-op
    without columns."""
    if not cols:
        return None
    return compact(spark, name, target_file_mb, order=list(cols))
