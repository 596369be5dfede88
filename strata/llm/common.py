"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: The word and white-space classes of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage
    cut that survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain column expression inside a lambda is evaluated again for every
    element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of ``text`` as an array; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """True for the rows no classifier may learn from (crc32 mod 4 is 2)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Texts:
    """A slice of texts as one byte buffer, with numpy views of its words.

    ``buf`` holds the UTF-8 bytes, ``bounds`` the n + 1 offsets of the texts,
    ``start``/``end`` the byte bounds of every word and ``doc`` the index of
    the text each word belongs to. NULL texts are empty.
    """

    def __init__(self, buf: np.ndarray, bounds: np.ndarray):
        self.buf, self.bounds, self.n = buf, bounds, len(bounds) - 1
        gap = (buf == 32) | ((buf >= 9) & (buf <= 13))
        edge = np.empty(len(buf) + 1, dtype=bool)
        edge[0], edge[-1] = True, True
        edge[1:-1] = gap[:-1]
        edge[bounds] = True
        word = ~gap
        self.start = np.flatnonzero(word & edge[:-1])
        after = np.append(gap, True)[1:]
        after[bounds[1:][bounds[1:] > 0] - 1] = True
        self.end = np.flatnonzero(word & after) + 1
        self.doc = np.searchsorted(bounds, self.start, side="right") - 1
        self.n_words = np.bincount(self.doc, minlength=self.n)
        self.first_word = np.concatenate([[0], np.cumsum(self.n_words)])

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text ``mask`` marks."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def words_with(self, mask: np.ndarray) -> np.ndarray:
        """How many words of each text ``mask`` (one flag a word) marks."""
        return np.bincount(self.doc[mask], minlength=self.n)


def text_slices(column: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, Texts]]:
    """``column`` (strings) as ``Texts`` of about ``max_bytes`` each, so that
    working memory follows the slice and not the Arrow batch. A longer text is
    a slice of its own. Yields (first row, texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, Texts(buf[offs[at]:offs[to]], offs[at:to + 1] - offs[at])
        at = to
