"""Line deduplication by log templates.

Lines are parsed by a tree of fixed depth: first by their number of words, then
by their leading words, words with digits standing for any such word. The lines
of a leaf are then told apart by the words that recur at later places. How
often is an absolute count, in doublings of what a template needs: at each of
these levels a line keeps the words that recur as often, its other places are
variable fields, and lines with the same pattern of kept words share a
template. Whatever the names in a field, there is a level above them and below
the words around them, and other lines of the leaf don't dilute a count. A
pattern counts if enough of the line's words are kept in it; the line itself
always does. A template that enough documents hold is boilerplate, and its
lines are dropped from all of them.

Everything is built-in expressions. Only lines of leaves that enough documents
share are ever looked at word by word, each distinct line once, and counts are
reduced before they are shuffled, so a line that a third of all documents hold
is a handful of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, WORD_BREAK, fresh, let, staged


@dataclass(frozen=True)
class Settings:
    """``depth`` leading words lead to a leaf. A line fits a template if
    ``alike`` of its words are the template's. Templates of ``least_docs``
    documents or more are dropped. Clean texts share short lines sooner, so
    templates of fewer than ``least_words`` words need ``short_docs``
    documents."""

    depth: int = 3
    alike: float = 0.7
    least_docs: int = 5
    least_words: int = 5
    short_docs: int = 10


ANY = "<*>"


def line_words(line: Column) -> Column:
    """Words of a line. Most lines have single spaces between their words and
    are split there without a pattern."""
    blanks = [line.contains(x) for x in ("  ", "\t", "\n", "\x0b", "\x0c", "\r")] + [line.startswith(" "), line.endswith(" "), line == ""]
    return F.when(reduce(or_, blanks), F.filter(F.split(line, WORD_BREAK), lambda w: w != "")).otherwise(F.split(line, " "))


def generalised(word: Column) -> Column:
    """The word, or the variable field if it holds a digit."""
    return F.when(word.rlike("[0-9]"), F.lit(ANY)).otherwise(word)


def generalised_words(words: Column, s: Settings, first: int | None = None) -> Column:
    """``words`` (or the ``first`` ones) with variable fields. A line of
    ``depth`` words or fewer that all hold digits would be nothing but fields:
    it stays as it is."""
    bare = (F.size(words) <= s.depth) & F.forall(words, lambda w: w.rlike("[0-9]"))
    return F.when(bare, words).otherwise(F.transform(words if first is None else F.slice(words, 1, first), generalised))


def needed_docs(words: Column, s: Settings) -> Column:
    return F.when(F.size(words) >= s.least_words, s.least_docs).otherwise(max(s.least_docs, s.short_docs))


def document_lines(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """(id, text_key, line, said, leaf, needs) for each line that is not blank;
    ``line`` is its number in the document, ``needs`` how many documents its
    template must be in."""
    keyed = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
                        F.col(f"`{text}`").alias("text"))  # below the explode: one hash a text, not one a line
    lines = keyed.select("id", "text_key", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    leaf = let(line_words(F.col("said")), lambda words: F.struct(
        F.xxhash64(F.size(words), generalised_words(words, s, s.depth)).alias("leaf"),
        needed_docs(words, s).alias("needs")))
    # a test of the line, not of its words: Spark would split the line once for each
    # or once more for a join's own test that a leaf is not NULL, hence the defaults
    return lines.where(F.col("said").rlike(WORD)).withColumn("found", leaf).select(
        "id", "text_key", "line", "said", F.coalesce("found.leaf", F.lit(0)).alias("leaf"),
        F.coalesce("found.needs", F.lit(s.least_docs)).alias("needs"))


def line_patterns(variants: DataFrame, s: Settings) -> DataFrame:
    """(a, b, n, needs, template) for ``variants`` (leaf, needs, a, b, words, n):
    the templates each distinct line may belong to, itself included. ``n`` is
    how many lines read so. One row per line and level at most, and as many
    levels as ``n`` has doublings."""
    places = variants.select("leaf", "needs", "a", "b", "n", F.posexplode("words").alias("at", "word"))
    often = places.where(F.col("word") != ANY).groupBy("leaf", "needs", "at", "word").agg(F.sum("n").alias("lines"))
    # a word's level is the number of binary digits of lines / needs, whole part
    often = staged(often.where("lines >= needs").select(
        "leaf", "at", "word", F.length(F.bin(F.floor(F.col("lines") / F.col("needs")))).alias("level")), "recurring-words")
    placed = places.join(often, ["leaf", "at", "word"], "left").groupBy("a", "b", "n", "needs").agg(F.array_sort(
        F.collect_list(F.struct("at", "word", F.coalesce("level", F.lit(0)).alias("level")))).alias("w"))
    levels = F.filter(F.array_distinct("w.level"), lambda t: (t > 0) & (
        F.size(F.filter("w", lambda x: x.level >= t)) >= s.alike * F.size("w")))
    kept = F.transform(levels, lambda t: F.concat_ws(" ", F.transform(
        "w", lambda x: F.when(x.level >= t, x.word).otherwise(ANY))))
    own = F.array(F.concat_ws(" ", "w.word"))
    return placed.select("a", "b", "n", "needs", F.explode(F.array_union(own, kept)).alias("template"))


def recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    settings: Settings = Settings()) -> DataFrame:
    """(id, text_key, line, template, n_docs) of every line that has a template
    which enough documents hold: the one that most hold, at a tie the greater
    text. Documents are told apart by id and text, so repeated rows count
    once."""
    s = settings
    lines = document_lines(docs, doc_id, text, s)
    doc = F.xxhash64("id", "text_key").alias("doc")
    leaves = lines.select("leaf", "needs", doc).distinct().groupBy("leaf", "needs").agg(F.count(F.lit(1)).alias("n"))
    # staged tables are shuffled for their joins, which lets Spark split a hot leaf's lines
    leaves = staged(leaves.where("n >= needs").select("leaf"), "shared-leaves")
    shared = lines.join(leaves, "leaf").select(
        "id", "text_key", "line", "leaf", "needs",
        let(line_words(F.col("said")), lambda words: generalised_words(words, s)).alias("words"))
    # distinct lines go by 128 bits of hash
    shared = staged(shared.select("*", F.xxhash64("leaf", "words").alias("a"), F.xxhash64("words", F.lit(1)).alias("b")), "shared-lines")

    variants = staged(shared.groupBy("leaf", "needs", "a", "b", "words").agg(F.count(F.lit(1)).alias("n")), "distinct-lines")
    patterns = staged(line_patterns(variants, s), "line-patterns")
    # no more documents than lines hold a template: most patterns end here
    alive = patterns.groupBy("template", "needs").agg(F.sum("n").alias("n")).where("n >= needs").select("template")
    patterns = staged(patterns.join(alive, "template").select("a", "b", "needs", "template"), "live-patterns")

    held = shared.select("a", "b", doc).distinct().join(patterns, ["a", "b"])
    counts = held.select("template", "needs", "doc").distinct().groupBy("template", "needs").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = staged(counts.where("n_docs >= needs").drop("needs"), "recurring-templates")
    best = staged(patterns.join(counts, "template").groupBy("a", "b").agg(
        F.max(F.struct("n_docs", "template")).alias("best")), "recurring-variants")
    return shared.join(best, ["a", "b"]).select("id", "text_key", "line", "best.template", "best.n_docs")


def drop_recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text``,
    and the number of them as ``n_dropped`` (with a trailing underscore if
    ``docs`` has such a column).

    NULL texts stay NULL, empty texts and texts without such lines stay as
    they are. Repeated rows and NULL ids are kept, each row treated alike.
    Other columns are passed through. An empty table gives no rows.
    """
    found = recurring_lines(docs, doc_id, text, settings)
    gone, fid, fkey = (fresh(docs, c) for c in ("__gone", "__of", "__text_key"))
    marks = staged(found.groupBy(F.col("id").alias(fid), F.col("text_key").alias(fkey)).agg(
        F.collect_set("line").alias(gone)), "dropped-lines")  # as many as one text has lines
    on = F.col(f"`{doc_id}`").eqNullSafe(F.col(fid)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(fkey))
    columns = docs.columns
    out = docs.join(marks.hint("merge"), on, "left")  # it grows with the corpus: never broadcast
    left = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i))
    n = fresh(docs, "n_dropped")
    return out.select(
        *[F.when(F.col(gone).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(left, "\n")).alias(c)
          if c == text else F.col(f"`{c}`") for c in columns],
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(n))
