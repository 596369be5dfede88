"""The registered queries of this subpackage, with SQL where SQL can say it.

``queries()`` and ``oracle_sql()`` have the driver's form. A query without SQL
is tested in ``tests/llm`` against brute force, a round trip or held-out rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat_format,
    context_tree,
    decontaminate,
    html_extract,
    line_templates,
    mixing,
    prefix_trie,
    quality_model,
    quality_rules,
    simhash,
    token_shards,
    toxicity_fm,
    vector_codes,
)
from strata.llm.common import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = chat_format.paired_answers(table(spark, sf_dir, "conversations"))
    out = chat_format.preference_pairs(chosen, rejected)

    def spans(mask: str) -> Column:  # "start-end start-end", the same in any engine
        return F.concat_ws(" ", F.transform(mask, lambda s: F.concat_ws("-", s["start"], s["end"])))

    return out.select(F.col("pair").alias("conv_id"), "prompt_turns", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"),
                      "rejected", spans("rejected_mask").alias("rejected_mask"))


OP3_SQL = """
WITH turns AS (
  SELECT conv_id, turn, min({'role': coalesce(role, ''), 'said': coalesce(text, '')}) AS t
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
answers AS (
  SELECT conv_id, max({'turn': turn, 'said': t.said}) AS last FROM turns WHERE t.role = 'assistant' GROUP BY conv_id),
others AS (
  SELECT a.conv_id, a.last, coalesce(b.conv_id, a.next) AS other
  FROM (SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS next FROM answers) a
  LEFT JOIN answers b ON b.conv_id = xor(a.conv_id, 1)),
sides AS (
  SELECT t.conv_id, t.turn, t.t.role AS role, t.t.said AS chosen,
    CASE WHEN t.turn = a.last.turn THEN o.last.said ELSE t.t.said END AS rejected
  FROM turns t JOIN others a USING (conv_id) JOIN answers o ON o.conv_id = a.other
  WHERE t.turn <= a.last.turn AND a.other <> a.conv_id),
split AS (
  SELECT *, coalesce(min(CASE WHEN chosen <> rejected THEN turn END) OVER (PARTITION BY conv_id), 9223372036854775807) AS parts
  FROM sides),
shown AS (
  SELECT *, '<|im_start|>' || role || chr(10) || chosen || '<|im_end|>' || chr(10) AS a,
    '<|im_start|>' || role || chr(10) || rejected || '<|im_end|>' || chr(10) AS b
  FROM split),
placed AS (
  SELECT *, turn >= parts AS rest,
    sum(length(a)) OVER (PARTITION BY conv_id, turn >= parts ORDER BY turn) AS a_end,
    sum(length(b)) OVER (PARTITION BY conv_id, turn >= parts ORDER BY turn) AS b_end
  FROM shown)
SELECT conv_id, CAST(count(*) FILTER (NOT rest) AS INTEGER) AS prompt_turns,
  coalesce(string_agg(a, '' ORDER BY turn) FILTER (NOT rest), '') AS prompt,
  coalesce(string_agg(a, '' ORDER BY turn) FILTER (rest), '') AS chosen,
  coalesce(string_agg((a_end - length(chosen) - 11)::BIGINT || '-' || a_end::BIGINT, ' ' ORDER BY turn)
    FILTER (rest AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(b, '' ORDER BY turn) FILTER (rest), '') AS rejected,
  coalesce(string_agg((b_end - length(rejected) - 11)::BIGINT || '-' || b_end::BIGINT, ' ' ORDER BY turn)
    FILTER (rest AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id
"""


OP4_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
lines AS (
  SELECT doc_id, i AS line, ls[i] AS said FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)),
plain AS (SELECT doc_id, line, [x for x in regexp_split_to_array(said, '[\x20\x09-\x0D]+') if x <> ''] AS w FROM lines),
words AS (
  SELECT doc_id, line, CASE WHEN len(w) <= 3 AND len([x for x in w if NOT regexp_matches(x, '[0-9]')]) = 0 THEN w
    ELSE [CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END for x in w] END AS w
  FROM plain WHERE len(w) > 0),
told AS (
  SELECT *, len(w) || ' ' || array_to_string(w[1:3], ' ') AS leaf, CASE WHEN len(w) >= 5 THEN 5 ELSE 10 END AS needs FROM words),
leaves AS (SELECT leaf FROM told GROUP BY leaf, needs HAVING count(DISTINCT doc_id) >= needs),
places AS (
  SELECT doc_id, line, leaf, needs, i AS pos, w[i] AS word
  FROM (SELECT told.*, unnest(range(1, len(w) + 1)) AS i FROM told JOIN leaves USING (leaf))),
often AS (
  SELECT leaf, pos, word, length(bin(count(*) // min(needs))) AS level FROM places WHERE word <> '<*>'
  GROUP BY leaf, pos, word HAVING count(*) >= min(needs)),
levels AS (
  SELECT doc_id, line, min(needs) AS needs, list(word ORDER BY pos) AS w, list(coalesce(level, 0) ORDER BY pos) AS v
  FROM places LEFT JOIN often USING (leaf, pos, word) GROUP BY doc_id, line),
named AS (
  SELECT doc_id, line, needs, array_to_string(w, ' ') AS template FROM levels
  UNION
  SELECT doc_id, line, needs, array_to_string([CASE WHEN v[i] >= t THEN w[i] ELSE '<*>' END for i in range(1, len(w) + 1)], ' ')
  FROM (SELECT *, unnest(list_distinct([x for x in v if x > 0])) AS t FROM levels)
  WHERE len([x for x in v if x >= t]) >= CAST(0.7 AS DOUBLE) * len(w)),
gone AS (
  SELECT DISTINCT doc_id, line FROM named WHERE template IN (
    SELECT template FROM named GROUP BY template, needs HAVING count(DISTINCT doc_id) >= needs)),
rest AS (
  SELECT l.doc_id, string_agg(said, chr(10) ORDER BY l.line) FILTER (g.line IS NULL) AS text, count(g.line) AS n
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN r.n > 0 THEN coalesce(r.text, '') ELSE d.text END AS text, coalesce(r.n, 0) AS n_dropped
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs)


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), ["doc_id"])
    return verdicts.select("doc_id", *quality_rules.STATS, "base_failed", "kept", "quality")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.token_shards(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.language_scores(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _kmeans_round(k: int) -> str:
    """SQL of round k: parts assigned to entries e{k}, and the entries after it."""
    return f"""
a{k} AS (
  SELECT rid, p.part, min({{'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), 'entry': entry}}) AS best
  FROM parts p JOIN e{k} ON p.part = e{k}.part GROUP BY rid, p.part),
s{k} AS (
  SELECT part, entry, place, CAST(floor(CAST(sum(x[place]) AS DOUBLE) / count(*)) AS BIGINT) AS c
  FROM (SELECT p.part, a.best.entry AS entry, x, unnest(range(1, len(x) + 1)) AS place FROM parts p JOIN a{k} a ON p.rid = a.rid AND p.part = a.part)
  GROUP BY ALL),
n{k} AS (SELECT part, entry, list(c ORDER BY place) AS c FROM s{k} GROUP BY part, entry),
e{k + 1} AS (SELECT e.part, e.entry, coalesce(n.c, e.c) AS c FROM e{k} e LEFT JOIN n{k} n ON e.part = n.part AND e.entry = n.entry),"""


#: For vectors of one length that 16 divides, and distinct vec_ids.
OP12_SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    [CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT) for y in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([1 for y in embedding if y IS NULL OR NOT isfinite(y)]) = 0),
parts AS MATERIALIZED (
  SELECT rid, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x
  FROM (SELECT rid, v, unnest(range(0, 16)) AS part FROM kept)),
e0 AS (SELECT part, rid - 1 AS entry, x AS c FROM parts WHERE rid <= 64),""" + _kmeans_round(0) + _kmeans_round(1) + """
a2 AS (
  SELECT rid, p.part, min({'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), 'entry': entry}) AS best
  FROM parts p JOIN e2 ON p.part = e2.part GROUP BY rid, p.part),
codes AS (
  SELECT rid, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 GROUP BY rid),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid), digest
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: For distinct turn numbers within a conversation. ``bytes`` is a CRC-32 table.
OP13_SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY x) AS crc
  FROM (SELECT unnest(range(0, 256)) AS x)),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
talks AS (SELECT conv_id, list(said ORDER BY i) AS said FROM own GROUP BY conv_id),
hashed AS (
  SELECT conv_id, said, xor(list_reduce(list_prepend(4294967295, [CAST(ascii(ch) AS BIGINT) for ch in string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda r, b: xor(r >> 8, crc[1 + (xor(r, b) & 255)])), 4294967295) % 4 AS h
  FROM talks, bytes),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.said, [])[1:a.h], a.said[a.h + 1:]) AS said
  FROM hashed a LEFT JOIN talks b ON b.conv_id = a.conv_id - a.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(said) AS whole, d, said[1:d] AS seq FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (
  SELECT seq, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole = d), '') AS ids
  FROM prefixes GROUP BY seq, d),
gains AS (
  SELECT *, (n_convs - 1) * coalesce(len([1 for w in regexp_split_to_array(seq[d].text, '[ 	-
]+') if w <> '']), 0) AS own FROM nodes),
family AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, count(k.d) AS n_children
  FROM gains n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.seq = n.seq[1:n.d - 1]
  LEFT JOIN nodes k ON k.d = n.d + 1 AND k.seq[1:n.d] = n.seq GROUP BY ALL),
below AS (
  SELECT seq[1:up] AS top, up, own, n_children FROM (SELECT seq, own, n_children, unnest(range(0, d + 1)) AS up FROM family)),
sums AS (SELECT top, up, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM below GROUP BY top, up)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ids) AS ends_sha256
FROM family JOIN sums ON top = seq AND up = d
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_extract, op2_quality_model, op3_preference_pairs, op4_line_templates, op5_toxicity_fm,
        op6_quality_rules, op7_simhash_dedup, op8_decontaminate, op9_token_shards, op10_mixing, op11_context_tree,
        op12_vector_codes, op13_prefix_trie)
}
ORACLE: dict[str, str] = {"op3_preference_pairs": OP3_SQL, "op4_line_templates": OP4_SQL,
                          "op12_vector_codes": OP12_SQL, "op13_prefix_trie": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
