"""Token shards: the permutation, exact round trips, and reading on from a slot."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import token_shards as T
from strata.llm.common import table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_slots_are_a_keyed_permutation(n):
    all_ = np.arange(n)
    s = T.slots(all_, n)
    assert sorted(s.tolist()) == all_.tolist()
    assert (T.slots(s, n, inverse=True) == all_).all()
    assert (T.slots(all_[::-1], n) == s[::-1]).all()
    if n > 16:
        assert (T.slots(all_, n, key=1) != s).any() and np.abs(np.diff(s)).mean() > n / 5


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.read_ranks(T.TOKENIZER))


def test_quick_pattern_gives_the_same_ids(encoder):
    texts = ["", " a", "a  b", "x\n y", "x \n\ny", "don't  we'll", "日本 語　 テスト", "a b ", "tabs\t\tand\x0bmore", "   x", "é ñ 12 3!? a\u0085 b"]
    want = [np.array(encoder.exact.encode_ordinary(t), dtype=encoder.kind).tobytes() for t in texts]
    assert list(encoder.encode(pa.array(texts))) == want
    assert list(encoder.encode(pa.array([None], pa.string()))) == [b""]


def shards(docs, tmp_path, **how):
    path = f"file://{tmp_path}/out"
    index = sorted(T.write_shards(docs, path, **how).collect(), key=lambda r: r["slot"])
    return path, index


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip(spark, tmp_path, encoder, parts):
    docs = table(spark, SF_SMALL, "documents").repartition(parts)
    path, index = shards(docs, tmp_path, sequence=256, shard_sequences=16)
    n = len(index)
    assert [r["slot"] for r in index] == list(range(n))
    read = list(T.read_sequences(path, sequence=256, shard_sequences=16))
    assert len(read) == n
    assert [zlib.crc32(x.tobytes()) for x in read] == [r["crc32"] for r in index]
    assert [(r["shard"], r["offset"]) for r in index] == [(k // 16, k % 16 * 512) for k in range(n)]
    on = list(T.read_sequences(path, 37, 256, 16))  # a reader that stopped goes on
    assert [x.tolist() for x in on] == [x.tolist() for x in read[37:]]
    # back in packing order, the tokens are the texts
    stream, texts = [], []
    for k in T.slots(np.arange(n), n).tolist():
        stream += read[k].tolist()[:index[k]["n_tokens"]]
    at = 0
    for k, token in enumerate(stream):
        if token == T.END:
            texts.append(encoder.exact.decode(stream[at:k]))
            at = k + 1
    assert sorted(texts) == sorted(r["text"] for r in docs.select("text").collect())
    ids = [d for k in T.slots(np.arange(n), n).tolist() for d in index[k]["doc_ids"]]
    assert set(ids) == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_awkward_rows(spark, tmp_path, awkward, clashing, no_docs):
    path, index = shards(clashing.coalesce(1), tmp_path, sequence=64, shard_sequences=8)
    ends = sum(int((x == T.END).sum()) for x in T.read_sequences(path, 0, 64, 8))
    padding = sum(64 - r["n_tokens"] for r in index)
    assert ends - padding == awkward.count()
    assert {d for r in index for d in r["doc_ids"]} == {r["doc_id"] for r in awkward.collect()}
    (tmp_path / "none").mkdir()
    path, index = shards(no_docs, tmp_path / "none")
    assert index == [] and list(T.read_sequences(path)) == []


def test_same_input_gives_the_same_shards(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    sums = [[r["crc32"] for r in shards(docs, tmp_path / str(k))[1]] for k in range(2)]
    assert sums[0] == sums[1]


def test_long_white_space_is_cut_as_the_pattern_does():
    import pyarrow as pa
    import tiktoken
    ranks = {bytes([b]): b for b in range(256)} | {b"  ": 256, b"    ": 257, b" a": 258, b"\n\n": 259}
    plain = tiktoken.Encoding("t", pat_str=T.CUT, mergeable_ranks=ranks, special_tokens={})
    n = T.LONG_GAP
    texts = [x for k in (n - 1, n, n + 1, 3 * n) for x in (
        "x" + " " * k + "a b", " " * k, "x " + "\n" * k + " \na", "a" + " " * k + "\u3000" * 3 + "1", " " * k + "x" + "\t" * k)]
    model = T.Encoder(ranks, 300)
    got = [np.frombuffer(b, model.kind).tolist() for b in model.encode(pa.array(texts))]
    assert got == [plain.encode_ordinary(t) for t in texts]
    assert len(list(model.encode(pa.array(["a" + " " * 10 ** 6 + "b"])))) == 1  # more than the pattern itself can take
