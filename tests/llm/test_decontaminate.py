"""Decontamination: Myers distance and matches against plain dynamic programming."""

import random
import re

import pytest

from strata.llm import decontaminate as D
from strata.llm.common import table
from tests.conftest import SF_SMALL


def words(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split()


def best_distance(pattern, text):
    """Smallest edit distance of ``pattern`` to any run of ``text``, and its first end."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for end, w in enumerate(text, 1):
        new = [0]
        for k, p in enumerate(pattern, 1):
            new.append(min(row[k - 1] + (p != w), row[k] + 1, new[k - 1] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], end)
    return best


def test_myers_search_is_edit_distance():
    r = random.Random(1)
    for _ in range(300):
        p = [r.choice("abcd") for _ in range(r.randrange(1, 80))]
        t = [r.choice("abcde") for _ in range(r.randrange(0, 120))]
        assert D.myers_search(p, t) == best_distance(p, t)


def mutated(item, edits, r):
    item = list(item)
    for _ in range(edits):
        k = r.randrange(len(item))
        kind = r.randrange(3)
        if kind == 0:
            item[k] = "changed"
        elif kind == 1 and len(item) > 2:
            del item[k]
        else:
            item.insert(k, "added")
    return item


def expected(docs, items):
    out = set()
    for d, text in docs:
        for i, item in items:
            p = words(item)
            if len(p) >= D.MIN_ITEM_WORDS:
                distance, _ = best_distance(p, words(text))
                if distance <= len(p) // D.WORDS_PER_EDIT:
                    out.add((d, i, distance))
    return out


@pytest.fixture(scope="module")
def planted():
    r = random.Random(9)
    say = lambda n: [r.choice("alpha beta gamma delta the of and to in is was for".split()) + r.choice(["", "s", "x1"]) for _ in range(n)]
    items = [(k, " ".join(say(n))) for k, n in enumerate([5, 6, 7, 8, 15, 16, 17, 40, 64, 90, 130])] + [(99, None), (None, "no id " * 9), (4, None)]
    docs = []
    for d in range(120):
        item = r.choice(items[:11])[1].split()
        budget = len(item) // D.WORDS_PER_EDIT
        copy = mutated(item, r.choice([0, 1, budget, budget + 1, budget + 4]), r)
        text = " ".join(say(r.randrange(0, 60)) + copy + say(r.randrange(0, 60)))
        docs.append((d, r.choice([text, text.upper(), text.replace(" ", "%%% "), text.replace(" ", ",\n ")])))
    return docs + [(500, None), (501, ""), (502, " ".join(say(20_000)))], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_planted_items_match_brute_force(spark, planted, block_bytes):
    docs, items = planted
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(d, b, block_bytes=block_bytes).collect()
    keyed = [(i, t) for i, t in items if i is not None and t is not None]
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == expected(docs, keyed)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    texts = dict(docs)
    for r in got:  # the place that is given has the distance that is given
        place = words(texts[r["doc_id"]])[r["first_word"]:r["end_word"]]
        assert best_distance(words(dict(keyed)[r["item_id"]]), place)[0] == r["distance"]
    clean = {r["doc_id"] for r in D.drop_contaminated(d, b, block_bytes=block_bytes).collect()}
    assert clean == set(texts) - {r["doc_id"] for r in got}


def test_documents_match_brute_force(spark):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    rows = [tuple(r) for r in docs.where("length(text) < 4000").select("doc_id", "text").collect()]
    items = [tuple(r) for r in bench.select("item_id", "text").collect()][:12]
    got = D.contaminated(docs.where("length(text) < 4000"), bench).collect()
    mine = {(r["doc_id"], r["item_id"], r["distance"]) for r in got if r["item_id"] in dict(items)}
    assert mine == expected(rows, items)


def test_awkward_rows(spark, awkward, clashing, no_docs):
    bench = spark.createDataFrame([(1, "a plain text of some words"), (1, "a plain text of some words"), (2, None), (3, "")],
                                  "item_id long, text string")
    got = D.contaminated(clashing, bench).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 2]
    kept = D.drop_contaminated(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == awkward.count() - 3
    assert D.contaminated(no_docs, bench).count() == 0 and D.drop_contaminated(no_docs, bench).count() == 0
    none = bench.limit(0)
    assert D.contaminated(awkward, none).count() == 0 and D.drop_contaminated(awkward, none).count() == awkward.count()


def test_short_and_unspaced_items(spark):
    """Short items are found as whole word runs, unspaced scripts by characters."""
    items = [(1, "Who wrote Pride and Prejudice?"), (2, "H2O"), (3, "誰が高慢と偏見を書きましたか"), (4, "ใครเขียนเรื่องนี้"), (5, "?!"), (6, "")]
    docs = [(1, "Q: who wrote pride, and prejudice? A: Austen"), (2, "who wrote pride and prejudices"), (3, "water is h2o."), (4, "h2o2"),
            (5, "問題:誰が高慢と偏見を書きましたか。"), (6, "問題:誰が高慢と偏見を読きましたか。"), (7, "誰が偏見を書いた"), (8, "ถาม ใครเขียนเรื่องนี้ ตอบ"), (9, "who wrote it")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in D.contaminated(d, b).collect()}
    assert got == {(1, 1, 0), (3, 2, 0), (5, 3, 0), (6, 3, 1), (8, 4, 0)}
    assert {r["doc_id"] for r in D.drop_contaminated(d, b).collect()} == {2, 4, 7, 9}
