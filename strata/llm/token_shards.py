"""Token-ID output in training order.

Texts become token ids, an end mark after each, packed one after the other
into sequences of a fixed length; the last sequence of each input partition is
padded with end marks. A keyed Feistel permutation, walked along its cycle
until it lands inside the range, gives every sequence a global slot: the
training order is a bijection that anyone with the key can compute. Sequences
go to the range of slots they belong to and are written, in slot order, to
shards in which each has the same number of bytes. Slot s is therefore at a
known offset of a known file, and a reader that stopped can go on from there.

Token ids pass through one staged table, so a lost executor costs its tasks
and never another look at the texts. A shard is written beside its final name
and renamed, and its content does not depend on the attempt.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.session import scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256
#: Fixed value: how texts are cut before byte-pair merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEQUENCE = 2048
SHARD_SEQUENCES = 4096
KEY = 0x5EED
ROUNDS = 6


#: Fixed value: the white space of CUT.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of white space from this length on is cut out of its text; the
#: pattern's look-ahead would run out of stack on a very long one.
LONG_GAP = 10_000


def long_gaps(text: str) -> Iterator[tuple[str, bool]]:
    """``text`` in parts that CUT would cut apart anyway, and whether a part is
    a long run of white space. Such a run keeps its last character for what
    follows, as CUT does; at the end of the text it is whole."""
    at = 0
    for gap in re.finditer(f"[{SPACE}]{{{LONG_GAP},}}", text):
        end = gap.end() if gap.end() == len(text) else gap.end() - 1
        yield text[at:gap.start()], False
        yield text[gap.start():end], True
        at = end
    yield text[at:], False


class Encoder:
    """Token ids of texts as little-endian bytes.

    The look-ahead in CUT only matters where white space follows white space,
    and patterns without look-ahead run much faster, so texts without such
    places are cut by the same pattern without it.
    """

    def __init__(self, ranks: dict[bytes, int], end: int = END):
        make = lambda cut: tiktoken.Encoding("ids", pat_str=cut, mergeable_ranks=ranks, special_tokens={})
        self.exact, self.quick = make(CUT), make(CUT.replace(r"|\s+(?!\S)", ""))
        self.kind = np.dtype("<u2" if max(end, *ranks.values()) < 1 << 16 else "<u4")
        self.end = np.array([end], dtype=self.kind).tobytes()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        wide = pc.match_substring_regex(texts, r"[\s\v\p{Z}\x{85}]{2}")
        for t, exact in zip(texts, wide, strict=True):
            model = self.exact if exact.as_py() else self.quick
            ids = [i for part, plain in long_gaps(t.as_py() or "") for i in (self.quick if plain else model).encode_ordinary(part)]
            yield np.array(ids, dtype=self.kind).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


@lru_cache(maxsize=1)
def _encoder(ranks: tuple[tuple[bytes, int], ...], end: int) -> Encoder:
    return Encoder(dict(ranks), end)


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
           end: int = END, sequence: int = SEQUENCE) -> DataFrame:
    """Sequences (part, nth, n_tokens, doc_ids, tokens) of the texts. A NULL
    or empty text is its end mark alone. ``doc_ids`` lists, in order, the rows
    that have tokens in the sequence; ``n_tokens`` does not count padding."""
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ranks = tuple(sorted(read_ranks(tokenizer).items()))
    sent = docs.sparkSession.sparkContext.broadcast((ranks, end))  # a vocabulary, about 2 MB
    schema = "part int, nth long, n_tokens int, doc_ids array<long>, tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*sent.value)
        width = sequence * encoder.kind.itemsize
        part, nth = TaskContext.get().partitionId(), 0
        stream, owners, rows = bytearray(), [], []

        def batch_of(rows: list) -> pa.RecordBatch:
            n, ids, data = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array(range(nth - len(rows), nth), pa.int64()),
                 pa.array(n, pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array(data, pa.binary())],
                names=["part", "nth", "n_tokens", "doc_ids", "tokens"])

        for batch in batches:
            for doc, tokens in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                stream += tokens + encoder.end
                owners.append((doc, len(stream)))
                at = 0
                while len(stream) - at >= width:
                    at += width
                    rows.append((sequence, [d for d, _ in owners], bytes(stream[at - width:at])))
                    nth += 1
                    owners = [(d, to) for d, to in owners if to > at]
                    if len(rows) >= 256:
                        yield batch_of(rows)
                        rows = []
                if at:
                    del stream[:at]
                    owners = [(d, to - at) for d, to in owners]
        if stream:
            n = len(stream) // encoder.kind.itemsize
            rows.append((n, [d for d, _ in owners], bytes(stream) + encoder.end * (sequence - n)))
            nth += 1
        if rows:
            yield batch_of(rows)

    return narrow.mapInArrow(run, schema)


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit mixing function."""
    x = (x ^ np.uint64(key & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def slots(index: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n - 1, or its inverse.

    A balanced Feistel network permutes the smallest even power of two that
    holds n; a value outside the range goes round again until it is inside.
    The power is less than 4 n, so that takes under four turns on average.
    """
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    out = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> np.uint64(half), out[todo] & mask
            for r in order:
                if inverse:
                    left, right = right ^ (_scramble(left, key * 31 + r) & mask), left
                else:
                    left, right = right, left ^ (_scramble(right, key * 31 + r) & mask)
            out[todo] = left << np.uint64(half) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 tokenizer: str = TOKENIZER, end: int = END, sequence: int = SEQUENCE,
                 shard_sequences: int = SHARD_SEQUENCES, key: int = KEY) -> DataFrame:
    """Write the shards below ``path`` (a folder that all executors share, as
    a URI that pyarrow knows) and return the index: slot, shard, offset,
    n_tokens, doc_ids and crc32 of every sequence.

    NULL doc_ids are listed as NULL. Repeated rows are written as often as
    they come. Extra columns are ignored. An empty table writes no shard and
    gives an empty index.
    """
    held = staged(packed(docs, doc_id, text, tokenizer, end, sequence), "token-sequences")
    counts = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per input partition
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_sequences))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress  # the shuffle moves about two thirds
        for b in batches:
            at = slots(b.column("place").to_numpy(), total, key)
            data = pa.array([pack(x.as_py()) for x in b.column("tokens")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), b.column("n_tokens"), b.column("doc_ids"), data], names=["slot", "n_tokens", "doc_ids", "data"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        unpack = zstandard.ZstdDecompressor().decompress
        shard = out = None

        def close() -> None:
            if out is not None:
                out.close()
                fs.move(beside, name)

        for b in batches:
            at = b.column("slot").to_numpy()
            places, sums = [], []
            for s, x in zip(at.tolist(), b.column("data"), strict=True):
                if s // shard_sequences != shard:
                    close()
                    shard = s // shard_sequences
                    name = f"{folder}/shard-{shard:08d}.bin"
                    beside = f"{folder}/.{shard:08d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(beside)
                data = unpack(x.as_py())
                places.append(s % shard_sequences * len(data))
                sums.append(zlib.crc32(data))
                out.write(data)
            yield pa.RecordBatch.from_arrays(
                [b.column("slot"), pa.array(at // shard_sequences), pa.array(places, pa.int64()),
                 b.column("n_tokens"), b.column("doc_ids"), pa.array(sums, pa.int64())],
                names=["slot", "shard", "offset", "n_tokens", "doc_ids", "crc32"])
        close()

    placed = held.join(F.broadcast(starts), "part").select(
        (F.col("start") + F.col("nth")).alias("place"), "n_tokens", "doc_ids", "tokens").mapInArrow(
        place, "slot long, n_tokens int, doc_ids array<long>, data binary")
    ranged = placed.repartitionById(shards, F.floor(F.col("slot") / shard_sequences).cast("int"))
    return staged(ranged.sortWithinPartitions("slot").mapInArrow(
        write, "slot long, shard long, offset long, n_tokens int, doc_ids array<long>, crc32 long"), "shard-index")


def read_sequences(path: str, first_slot: int = 0, sequence: int = SEQUENCE,
                   shard_sequences: int = SHARD_SEQUENCES, kind: str = "<u2") -> Iterator[np.ndarray]:
    """The sequences from ``first_slot`` on, in slot order, by seeking."""
    fs, folder = pafs.FileSystem.from_uri(path)
    width = sequence * np.dtype(kind).itemsize
    shard, skip = divmod(first_slot, shard_sequences)
    while fs.get_file_info(name := f"{folder}/shard-{shard:08d}.bin").type == pafs.FileType.File:
        with fs.open_input_file(name) as f:
            f.seek(skip * width)
            while data := f.read(width):
                yield np.frombuffer(data, dtype=kind)
        shard, skip = shard + 1, 0


def token_shards(docs: DataFrame) -> DataFrame:
    """``write_shards`` with production parameters, to a new folder below the
    cluster's shared one, which column ``path`` names."""
    path = scratch_path(docs.sparkSession, "token-shards")
    path = path if ":" in path.split("/")[0] else f"file://{path}"
    return write_shards(docs, path).withColumn("path", F.lit(path))
