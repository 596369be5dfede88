"""The conversation trie against plain Python, and its parentheses."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import prefix_trie as P
from strata.llm.common import table
from strata.llm.parentheses import Parentheses
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def tie(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), tie(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lender = c - int(np.fmod(c, 20))
        rebuilt[c] = own.get(lender, [])[:h] + turns[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[:d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def result(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r[c] for c in names) for r in df.select(*names).collect())


def talks(seed, n, texts, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(texts))
            for c in rng.sample(range(-30, 4 * n), n) for t in range(rng.randint(1, longest))]


def test_parentheses_find_their_partners():
    rng = random.Random(3)
    for size in (1, 2, 5, 40, 700):
        bits, open_ = [1], 1
        for _ in range(size):
            go = open_ == 1 or rng.random() < 0.52
            bits.append(int(go))
            open_ += 1 if go else -1
        bits += [0] * open_
        stack, partner = [], {}
        for k, b in enumerate(bits):
            if b:
                stack.append(k)
            else:
                partner[stack.pop()] = k
        for block in (4, 64):
            tree = Parentheses(np.array(bits), block)
            at = np.array(sorted(partner))
            assert tree.find_close(at).tolist() == [partner[k] for k in at]
            assert tree.rank_open(at).tolist() == [sum(bits[:k]) for k in at]


@pytest.mark.parametrize("seed,n,texts,longest,shard", [
    (1, 60, ["a", "a b", "", "c d e"], 6, 4), (2, 150, ["a"], 5, 8), (3, 80, [f"t {k}" for k in range(40)], 4, 1 << 19),
    (4, 120, ["x y", "z"], 9, 30)])
def test_trie_against_plain_python(spark, seed, n, texts, longest, shard):
    rows = talks(seed, n, texts, longest)
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_chains=shard, shard_rows=4)
    assert result(got) == brute(rows)


def test_given_conversations(spark):
    df = table(spark, SF_SMALL, "conversations")
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in df.collect()]
    assert result(P.prefix_trie(df)) == brute(rows)


def test_copies_of_one_conversation_and_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(P, "IDS_A_PIECE", 7)
    monkeypatch.setattr(P, "WINDOW_TURNS", 16)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 400) for t in range(3)]
    rows += [(c, t, "user", f"long {t % 5}") for c in (4000, 4001) for t in range(90)]
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_chains=16, shard_rows=4)
    assert result(got) == brute(rows)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", ""), (1, 2, "user", "b"), (1, 2, "user", "a"), (1, 2, "user", "a"), (None, 0, "user", "x"),
            (None, None, None, None), (-7, 0, "user", " \t\x0b "), (20, 5, "assistant", "日本 語"), (20, 5, "assistant", "日本 語"),
            (21, 0, "user", "x"), (22, 0, "user", "y"), (23, 0, "user", "y"), (25, 0, "u", "long " * 20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(P.prefix_trie(df)) == brute(rows)
    from pyspark.sql import functions as F
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("n", "m", "depth", "path", "place", "p1", "n_convs", "key", "words", "rank")])
    assert result(P.prefix_trie(clash)) == brute(rows)


def test_conversations_that_lose_all_turns(spark):
    """One turn, more to borrow than it has, and no lender: the root is its end."""
    lost = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "only") for c in lost[:30]]
    got = result(P.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and len(got) == 1


def test_no_conversations(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
