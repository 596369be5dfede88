"""Language-model scores against context-tree weighting in plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import context_tree as C
from strata.llm.common import table
from tests.conftest import SF_SMALL

LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def steps(text, depth):
    """(context, known bits, bit) of every binary decision."""
    data = b"\0" * depth + " ".join(words(text)).encode() + b"\n"
    for k in range(depth, len(data)):
        known = ""
        for bit in f"{data[k]:08b}":
            yield data[k - depth:k], known, int(bit)
            known += bit


def kt(zeros, ones):
    out = 0.0
    for n, rest in ((zeros, 0), (ones, zeros)):
        for k in range(n):
            out += math.log((k + 0.5) / (k + rest + 1))
    return out


def brute(rows, depth=C.DEPTH):
    seen = defaultdict(lambda: [0, 0])
    for i, text in rows:
        if not held(i):
            for ctx, known, bit in steps(text, depth):
                for d in range(depth + 1):
                    seen[ctx[depth - d:], known][bit] += 1
    weight, below = {}, defaultdict(float)
    for (ctx, known), n in sorted(seen.items(), key=lambda x: -len(x[0][0])):
        own = kt(*n)
        w = own if len(ctx) == depth else np.logaddexp(own, below[ctx, known]) - math.log(2)
        weight[ctx, known] = w
        if ctx:
            below[ctx[1:], known] += w

    def p_one(ctx, known):
        mixed, left = 0.0, 1.0
        for d in range(depth + 1):
            node = (ctx[depth - d:], known)
            if node not in seen:
                break
            own = kt(*seen[node])
            share = 1.0 if d == depth else 1 / (1 + math.exp(min(below[node] - own, 700)))
            mixed += left * share * (seen[node][1] + 0.5) / (sum(seen[node]) + 1)
            left *= 1 - share
        return mixed + left / 2

    count, n_train = Counter(), 0
    for i, text in rows:
        if not held(i):
            count.update(words(text))
            n_train += 1
    total, kinds = sum(count.values()) + n_train, len(count) + (n_train > 0)
    out = []
    for i, text in rows:
        tokens = [count[w] for w in words(text)] + [n_train]
        base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in tokens)
        score = sum(math.log10(p if bit else 1 - p) for ctx, known, bit in steps(text, depth) for p in [p_one(ctx, known)])
        out.append((i, held(i), len(tokens), sum(c > 0 for c in tokens), total, base, score))
    return sorted(out, key=str)


def check(df, rows):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    want = brute(rows)
    key = lambda r: (str(r[:5]), round(r[6], 3))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-6, abs=1e-6) for w in want]


ROWS = [(k, f"The cat {'sat' if k % 3 else 'ran'} on mat {k % 5}\tand THE dog\n\n é{k % 2} 日本") for k in range(40)]
ROWS += [(k, f"new{k} words xyz-{k}") for k in range(100, 108)] + [(3, ROWS[3][1])]


def test_scores_against_plain_python(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    check(C.language_scores(df), ROWS)


def test_blocks_of_nodes_and_rare_words_change_nothing(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    check(C.language_scores(df, block_nodes=900, hot_share=0.02), ROWS)


def test_slices_and_gram_chunks_cut_nothing():
    import pyarrow as pa
    column = pa.array([t for _, t in ROWS] + [None, "", "a" * 5000])
    whole = C.Slice(column)
    parts = list(C.slices(column, 200))
    assert len(parts) > 10 and sum(p.n for _, p in parts) == len(column)
    one = np.concatenate([g for g, _ in whole.grams()])
    assert (one == np.concatenate([g for g, _ in whole.grams(size=37)])).all()
    assert (one == np.concatenate([g for _, p in parts for g, _ in p.grams()])).all()


def test_kt_is_the_product_of_its_predictions():
    for a, b in ((0, 0), (1, 0), (0, 7), (3, 5), (60, 41)):
        assert C.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(kt(a, b), abs=1e-10)
    assert C.log_kt(np.array([10 ** 9]), np.array([0]))[0] == pytest.approx(-0.5 * math.log(math.pi * 10 ** 9), abs=1e-6)


def test_probabilities_of_a_byte_add_up_to_one(spark):
    grams = spark.createDataFrame([(int.from_bytes(b"cat sat on"[k:k + C.DEPTH + 1], "big"), 3 + k) for k in range(4)], "gram long, n long")
    model = C.Model(grams)
    trees = model.block(*model.blocks()[0])
    for ctx in (b"cat sat on"[:C.DEPTH], b"xxx sat on"[:C.DEPTH], b"\0" * C.DEPTH):
        every = np.array([int.from_bytes(ctx, "big") << 8 | b for b in range(256)], np.uint64)
        assert (10 ** trees.log10_p(every)).sum() == pytest.approx(1, abs=1e-6)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] != 6]
    check(C.language_scores(awkward.where("doc_id is null or doc_id <> 6")), rows)
    check(C.language_scores(clashing.where("doc_id is null or doc_id <> 6")), rows)
    assert C.language_scores(no_docs).count() == 0
    assert C.language_scores(awkward).count() == awkward.count()  # with its long text


def test_nothing_to_learn_from(spark):
    lost = [k for k in range(60) if held(k)]
    rows = [(k, "a b") for k in lost]
    check(C.language_scores(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_real_texts_score_above_shuffled_ones(spark):
    """On held-out rows: the same letters in another order are far less likely."""
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = docs.where(C.held_out_of_language(F.col("doc_id"))).collect()
    rng = random.Random(1)
    ids = iter(k for k in range(10 ** 6, 2 * 10 ** 6) if held(k))
    mixed = {next(ids): ("".join(rng.sample(r["text"], len(r["text"]))), r["doc_id"]) for r in texts if len((r["text"] or "").split()) > 20}
    extra = spark.createDataFrame([(k, t) for k, (t, _) in mixed.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["bits_per_byte"] for r in C.language_scores(docs.unionByName(extra)).where("held_out").collect()}
    worse = [got[k] > got[i] + 0.5 for k, (_, i) in mixed.items()]
    assert len(worse) > 10 and sum(worse) >= 0.9 * len(worse)
