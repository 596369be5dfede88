"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as word sequences after lower-casing and
dropping everything but letters, marks and digits; in scripts written without
spaces every character is a word. An item of n words may
occur with up to n // WORDS_PER_EDIT word edits. Cut into one more piece than
that, at least one piece occurs unchanged, so exact piece hits (one
Aho-Corasick pass over each whole text) find every candidate place, and the
place is verified with Myers' bit-parallel edit distance over words.

The corpus is only streamed: no shuffle, no join. Items travel to the tasks in
blocks of at most BLOCK_BYTES, each block one pass over the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh

WORDS_PER_EDIT = 8
#: Every item with a word is searched; one under WORDS_PER_EDIT words is found
#: only where it occurs unchanged, as a run of whole words.
MIN_ITEM_WORDS = 1
#: Characters of scripts that put no spaces between words.
UNSPACED = "[" + "".join(rf"\p{{Is{s}}}" for s in (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")) + "]"
BLOCK_BYTES = 16 << 20

Item = tuple[int, str]
Hit = tuple[int, int, int, int]


def plain_words(text: Column) -> Column:
    """Lower-case words of ``text``, one space between them."""
    spaced = F.regexp_replace(F.lower(text), UNSPACED, " $0 ")
    return F.trim(F.regexp_replace(spaced, r"[^\p{L}\p{M}\p{N}]+", " "))


def pieces_of(words: list[str], edits: int) -> list[tuple[int, str]]:
    """(first word, phrase) of edits + 1 pieces of nearly equal length."""
    cuts = [len(words) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, " ".join(words[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers_search(pattern: list[str], words: list[str]) -> tuple[int, int]:
    """(distance, end) of the best match of ``pattern`` that ends anywhere in
    ``words``: the smallest distance, then the first end (a word count)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for k, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = (m, 0)
    for end, w in enumerate(words, 1):
        same = masks.get(w, 0)
        vert = same | down
        horiz = (((same & up) + up) ^ up) | same
        plus = down | ~(horiz | up)
        minus = up & horiz
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(vert | plus)) & full, plus & vert & full
        if score < best[0]:
            best = (score, end)
    return best


class Matcher:
    """The items of one block, ready to be found in texts."""

    def __init__(self, items: tuple[Item, ...]):
        self.items = [(i, t.split(" ")) for i, t in items]
        phrases: dict[str, list[tuple[int, int]]] = {}
        for n, (_, words) in enumerate(self.items):
            for first, phrase in pieces_of(words, len(words) // WORDS_PER_EDIT):
                phrases.setdefault(f" {phrase} ", []).append((n, first))
        self.found = ahocorasick.Automaton()
        for phrase, places in phrases.items():
            self.found.add_word(phrase, (len(phrase), places))
        self.found.make_automaton()
        self.any = bool(phrases)

    def hits(self, text: str) -> list[Hit]:
        """(item_id, distance, first word, end word) of the best match of each
        item that ``text`` (plain words) holds within its edit budget."""
        if not self.any or not text:
            return []
        padded, words = f" {text} ", None
        best: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, int] = {}
        at = spaces = 0
        for end, (size, places) in self.found.iter(padded):
            start = end - size + 1
            words = words or text.split(" ")
            spaces += padded.count(" ", at, start) if start >= at else -padded.count(" ", start, at)
            at = start
            for n, first in places:
                _, item = self.items[n]
                edits = len(item) // WORDS_PER_EDIT
                begin = spaces - first
                if best.get(n, (1,))[0] == 0 or seen.get(n) == begin:
                    continue
                seen[n] = begin  # the next piece of the same place
                low = max(0, begin - edits)
                window = words[low:begin + len(item) + edits]
                distance, stop = myers_search(item, window)
                if distance <= edits and distance < best.get(n, (edits + 1,))[0]:
                    _, back = myers_search(item[::-1], window[:stop][::-1])
                    best[n] = (distance, low + stop - back, low + stop)
        return [(self.items[n][0], *found) for n, found in sorted(best.items())]


@lru_cache(maxsize=2)
def _matcher(items: tuple[Item, ...]) -> Matcher:
    return Matcher(items)


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The distinct items as frames (item_id, words) of about ``block_bytes``
    of text each. NULL ids and texts, and items without words, are left
    out."""
    words = benchmark.select(F.col(item_id).cast("long").alias("item_id"), plain_words(F.col(text)).alias("words"))
    words = words.where("item_id is not null and words <> ''").where(
        F.size(F.split("words", " ")) >= MIN_ITEM_WORDS).distinct()
    total = words.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    return [words.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == b) for b in range(blocks)]


def _items(block: DataFrame) -> tuple[Item, ...]:
    return tuple(sorted((r["item_id"], r["words"]) for r in block.collect()))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each row of ``docs`` and each item it holds: doc_id, item_id,
    distance (word edits), first_word and end_word of the best match (the
    smallest distance, then the first found), counted in plain words.

    NULL and empty texts hold nothing. Repeated rows of ``docs`` give a row
    each; repeated items count once. NULL doc_ids are passed through. Extra
    columns are ignored. Either table empty: no rows.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), plain_words(F.col(text)).alias("words"))
    kind = "item_id long, distance long, first_word long, end_word long"
    schema = plain.select("doc_id", *[F.lit(0).cast("long").alias(c.split()[0]) for c in kind.split(", ")]).schema
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(_items(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent.value)
            for batch in batches:
                rows, found = [], []
                for k, t in enumerate(batch.column(1)):
                    for hit in matcher.hits(t.as_py() or ""):
                        rows.append(k)
                        found.append(hit)
                cols = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, pa.int64()) for c in cols]],
                    names=schema.names)

        out = out.unionByName(plain.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      item_id: str = "item_id", item_text: str = "text",
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold an item, filtered as they stream.
    NULL and empty texts stay, as do all columns."""
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(_items(block))
        col = fresh(docs, "__plain")

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent.value)
            for batch in batches:
                clean = [not matcher.hits(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(
                    pa.array(clean, pa.bool_()))

        schema = docs.schema
        docs = docs.withColumn(col, plain_words(F.col(f"`{text}`"))).mapInArrow(run, schema)
    return docs
