"""Column-level operators: flatten, name, clean, type, explode, date parts.

Each one is a single projection (or a single generator) over the input, so
Catalyst collapses a chain of them into one ``Project`` and prunes unused
columns down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from strata.functions.scalars import BLANK_DEFAULT, clean_string, col_of

# Characters replaced by an underscore, and characters dropped,
# when column names are normalised. Names are lower-cased afterwards.
NAME_TO_UNDERSCORE = [".", " ", "-"]
NAME_DROPPED = ["(", ")"]


class NameCollision(ValueError):
    pass


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _resolve_collisions(names: list[str], on_collision: str) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n.lower() in seen:
            if on_collision == "error":
                dupes = [m for m in names if m.lower() == n.lower()]
                raise NameCollision(f"columns collide after renaming: {dupes}")
            seen[n.lower()] += 1
            n = f"{n}_{seen[n.lower()]}"
        seen.setdefault(n.lower(), 0)
        out.append(n)
    return out


def flatten_structs(df: DataFrame, sep: str = "_",
                    on_collision: str = "error") -> DataFrame:
    """One column per struct leaf, named by its path; arrays stay whole.

    A NULL or missing struct gives NULL leaves. Leaves whose paths join to
    the same name raise ``NameCollision`` (or get a numeric suffix with
    ``on_collision="suffix"``).
    """
    leaves: list[tuple[list[str], DataType]] = []

    def walk(path: list[str], dtype: DataType) -> None:
        if isinstance(dtype, StructType) and dtype.fields:
            for f in dtype.fields:
                walk(path + [f.name], f.dataType)
        else:
            leaves.append((path, dtype))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    names = _resolve_collisions([sep.join(p) for p, _ in leaves], on_collision)
    cols = [F.col(".".join(_quote(p) for p in path)).alias(name)
            for (path, _), name in zip(leaves, names)]
    return df.select(*cols)


def normalized_name(name: str) -> str:
    for ch in NAME_TO_UNDERSCORE:
        name = name.replace(ch, "_")
    for ch in NAME_DROPPED:
        name = name.replace(ch, "")
    return name.lower()


def normalize_names(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Rename every column by the fixed rule above, in one projection."""
    names = _resolve_collisions([normalized_name(c) for c in df.columns],
                                on_collision)
    return df.toDF(*names)


def clean_strings(df: DataFrame, default: str = BLANK_DEFAULT,
                  columns: Iterable[str] | None = None) -> DataFrame:
    """Trim every top-level string column; NULL or blank becomes ``default``.

    Other types, including strings inside arrays or structs, are untouched.
    Idempotent.
    """
    wanted = set(columns) if columns is not None else None
    cols = []
    for f in df.schema.fields:
        c = F.col(_quote(f.name))
        if isinstance(f.dataType, StringType) and (wanted is None or f.name in wanted):
            c = clean_string(c, default).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def fill_numbers(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, default)`` for the given columns, in one projection."""
    cols = [F.coalesce(F.col(_quote(n)), F.lit(defaults[n])).alias(n)
            if n in defaults else F.col(_quote(n)) for n in df.columns]
    return df.select(*cols)


def apply_types(df: DataFrame, spec: Mapping[str, str | Column],
                keep_others: bool = True) -> DataFrame:
    """Typed projection. A type name is applied with ``try_cast`` (bad text
    becomes NULL); a Column is used as the expression for that output."""
    cols = []
    for n in df.columns:
        if n in spec:
            s = spec[n]
            cols.append((s if isinstance(s, Column)
                         else F.col(_quote(n)).try_cast(s)).alias(n))
        elif keep_others:
            cols.append(F.col(_quote(n)))
    return df.select(*cols)


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows where any business-key part is NULL."""
    return df.dropna(how="any", subset=list(keys))


def with_parent_id(df: DataFrame, name: str, value: object) -> DataFrame:
    """Tag each child row with its parent id (a literal or a column)."""
    v = value if isinstance(value, Column) else (
        F.col(value) if isinstance(value, str) and value in df.columns else F.lit(value))
    return df.withColumn(name, v)


def explode_rows(df: DataFrame, column: str, alias: str,
                 outer: bool = False, keep: Iterable[str] | None = None) -> DataFrame:
    """One row per array element. The inner form drops NULL and empty arrays;
    ``outer=True`` keeps them with a NULL element."""
    gen = F.explode_outer if outer else F.explode
    others = [c for c in (keep if keep is not None else df.columns) if c != column]
    return df.select(*[F.col(_quote(c)) for c in others],
                     gen(F.col(_quote(column))).alias(alias))


def with_date_parts(df: DataFrame, source: str | Column,
                    prefix: str = "partition_") -> DataFrame:
    """Add ``{prefix}year/month/day`` (int) from a date or timestamp."""
    c = col_of(source)
    return df.select("*",
                     F.year(c).alias(f"{prefix}year"),
                     F.month(c).alias(f"{prefix}month"),
                     F.dayofmonth(c).alias(f"{prefix}day"))
