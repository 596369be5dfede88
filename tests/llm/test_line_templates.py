"""Line templates: recurring lines go, everything else stays as it was."""

import re

from pyspark.sql import functions as F

from strata.llm import line_templates as L
from strata.llm.common import table
from tests.conftest import SF_SMALL

DOC = "doc_id long, text string"


def brute(docs, s):
    """(doc, line) of recurring templates, by plain Python."""
    rows = {(d, t) for d, t in docs if t is not None}
    lines = {}
    for d, t in rows:
        for k, line in enumerate(t.split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            if len(words) > s.depth or any(not re.search("[0-9]", w) for w in words):
                words = [L.ANY if re.search("[0-9]", w) else w for w in words]
            if words:
                lines[(d, t, k)] = tuple(words)
    needs = lambda w: s.least_docs if len(w) >= s.least_words else max(s.least_docs, s.short_docs)
    leaves = {}
    for key, w in lines.items():
        leaves.setdefault((len(w), w[:s.depth]), []).append(key)
    held = {}
    for keys in leaves.values():
        if len({k[:2] for k in keys}) < needs(lines[keys[0]]):
            continue
        count = {}
        for k in keys:
            for at, w in enumerate(lines[k]):
                count[at, w] = count.get((at, w), 0) + (w != L.ANY)
        for k in keys:
            w = lines[k]
            held.setdefault(w, set()).add(k)
            least = needs(w)
            while least <= max(count.values()):  # twice as often each time
                kept = [count[at, x] >= least for at, x in enumerate(w)]
                if sum(kept) >= s.alike * len(w):
                    held.setdefault(tuple(x if y else L.ANY for x, y in zip(w, kept)), set()).add(k)
                least *= 2
    return {(d, k) for w, keys in held.items() if len({x[:2] for x in keys}) >= needs(w) for d, _, k in keys}


def found(docs, s=L.Settings()):
    return {(r["id"], r["line"]) for r in L.recurring_lines(docs, settings=s).collect()}


def test_documents_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for s in (L.Settings(), L.Settings(depth=2, least_docs=3, alike=0.5, least_words=3)):
        assert found(docs, s) == brute(rows, s)
    texts = dict(rows)
    gone = brute(rows, L.Settings())
    for r in L.drop_recurring_lines(docs).collect():
        left = [x for k, x in enumerate(texts[r["doc_id"]].split("\n")) if (r["doc_id"], k) not in gone]
        assert r["text"] == "\n".join(left)
        assert r["n_dropped"] == sum(d == r["doc_id"] for d, _ in gone)


def test_variable_fields(spark):
    """Dates and names vary; the same words in another order are another line."""
    rows = [(k, f"unique words {k} a{k} b{k} c{k}\nposted on day {k} of month by user{k}\nThe quick report by {n} is now ready\nkeep me")
            for k, n in enumerate("ann bob cat dan eve fay".split())]
    out = {r["doc_id"]: r["text"] for r in L.drop_recurring_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert set(out.values()) == {f"unique words {k} a{k} b{k} c{k}\nkeep me" for k in range(6)} or all(
        t.endswith("keep me") and "posted" not in t and "quick" not in t for t in out.values())


def test_awkward_rows(spark, awkward, clashing, no_docs):
    out = L.drop_recurring_lines(clashing)
    assert out.columns == [*clashing.columns, "n_dropped_"]
    same = sorted((tuple(r[:5]) for r in out.collect()), key=str)
    assert same == sorted((tuple(r) for r in awkward.collect()), key=str)
    assert L.drop_recurring_lines(no_docs).count() == 0
    repeated = spark.createDataFrame([(1, "one two three four five six")] * 50, DOC)  # one document, however often
    assert L.drop_recurring_lines(repeated).where("n_dropped > 0").count() == 0


def test_hot_line(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('own', id, ' text', id, if(id % 3 = 0, '\n all rights are reserved by us', '')) as text")
    out = L.drop_recurring_lines(docs)
    assert out.where(F.col("text").contains("reserved")).count() == 0 and out.agg(F.sum("n_dropped")).first()[0] == 1000


def test_main_path_is_native(spark):
    plan = L.drop_recurring_lines(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_short_lines(spark):
    """Boilerplate of one to four words goes; numbers alone are no template."""
    own = [f"own text of {a}{b} and more" for a in "abc" for b in "defg"]
    rows = [(k, f"{x}\nAll rights reserved.\nShare\n\npage {k}\n{k}77\n 42 \nIn nine texts{' only' if k > 8 else ''}") for k, x in enumerate(own)]
    out = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in L.drop_recurring_lines(
        spark.createDataFrame(rows, DOC), settings=L.Settings(alike=0.99)).collect()}
    assert out == {k: (f"{x}\n\n{k}77\nIn nine texts{' only' if k > 8 else ''}", 4) for k, x in enumerate(own)}


FIRST, LAST = "ann bob cat dan eve fay gus hal ivy jon kim lee mia ned ora".split(), "ash bay cox day elm fox gee hay".split()


def test_template_beside_other_lines_of_its_leaf(spark):
    """A template goes however many other lines begin as it does and whatever
    recurs in its fields; those other lines stay."""
    written = [f"This article was written by {FIRST[k % 15]} {LAST[k // 15 % 8]}{'abcdefgh'[k % 7]}" for k in range(300)]
    spell = lambda k: "".join(chr(97 + k // 26 ** i % 26) for i in range(3))
    other = [f"This article was q{spell(k)} r{spell(k)} s{spell(k)} t{spell(k)}" for k in range(700)]
    for more in ([], other):
        rows = list(enumerate(written + more))
        gone = found(spark.createDataFrame(rows, DOC))
        assert gone == {(k, 0) for k in range(300)} == brute(rows, L.Settings())


def test_three_templates_in_a_leaf(spark):
    rows = []
    for k in range(90):
        name = f"{FIRST[k % 15]}{'abcdefgh'[k % 8]}"
        rows.append((k, [f"All of the photographs were taken by {name}", f"All of the prices below include {name} tax",
                         f"All of the comments here belong to {name}"][k % 3]))
    got = L.recurring_lines(spark.createDataFrame(rows, DOC)).collect()
    assert {(r["template"], r["n_docs"]) for r in got} == {
        ("All of the photographs were taken by <*>", 30), ("All of the prices below include <*> tax", 30),
        ("All of the comments here belong to <*>", 30)}


def test_long_lines(spark):
    """A line of very many words in many documents; at most one place differs."""
    base = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000))
    rows = [(k, f"own line {FIRST[k]}\n{base} {FIRST[k]}") for k in range(6)]
    assert found(spark.createDataFrame(rows, DOC)) == {(k, 1) for k in range(6)}
