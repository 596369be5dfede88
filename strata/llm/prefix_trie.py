"""The trie of conversations that share their first turns.

Conversations are rebuilt so that neighbours share a beginning (``rebuilt_turns``).
A node is a distinct sequence of first turns, named by its depth and a 128-bit
hash of it: the exclusive or of one hash per (place, role, text), which a running
aggregate gives without collecting a conversation. Grouping by that name gives
each node's members; a run of nodes with the same members is one chain, named by
(smallest member, members), and all its nodes follow from one by arithmetic.

What asks for whole subtrees runs on the trie of chains:

* every distinct sequence is the list of chains it passes. Members fall along
  it, so a list of k chains takes k * k / 2 turn rows at least: it is never
  longer than the square root of twice the rows;
* the lists are range-partitioned, which is preorder, and taken in shards of at
  most ``SHARD_CHAINS`` list entries (but ``SHARD_ROWS`` lists);
* a shard's trie is encoded in balanced parentheses (``parentheses``): finding
  the closing one delimits a subtree, the rank of leaf pairs in between counts
  its leaves, cumulative arrays by preorder give its savings and members;
* a chain whose members all lie in the shard is finished. The others are on the
  shard's first or last path, its spine. These two paths, with what the shard
  has added up beneath each of their chains, are the lists of the next round,
  where shared spines meet and merge, until the root is finished.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, staged
from strata.llm.parentheses import Parentheses
from strata.operators.marts import with_rank

#: Neighbours: conversations borrow from the one whose id is the next multiple below.
BORROW_FROM = 20
MAX_BORROWED = 3
#: A shard is closed at so many list entries, if it has SHARD_ROWS lists.
SHARD_CHAINS = 1 << 19
SHARD_ROWS = 64
#: Lists of a later round that one task takes; there are two a shard.
MERGE_ROWS = 1 << 13
#: Turns of a conversation that one window runs over.
WINDOW_TURNS = 1 << 16
#: Ids that one row carries while the members of a node are hashed.
IDS_A_PIECE = 4096

_PATH = "array<struct<p1: long, p2: long, m: long, n: long, own: long>>"
_SUMS = ("leaves", "saved", "kids", "members")


# ---------------------------------------------------------------- conversations
def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, turns, key, words), (conv_id, turns)): the turns of
    every rebuilt conversation, numbered from one, and all conversations.

    Turns are ordered by turn (NULL first), ties by a hash of role and text.
    NULL role and text are empty. Rows without a whole-number conv_id are no
    conversation. Repeated rows are repeated turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    own = conversations.select(F.col("conv_id").try_cast("long").alias("conv_id"), F.col("turn"), key.alias("key"),
                               F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).where("conv_id is not null")
    own = with_rank(own, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key")], "rank")
    talks = own.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    talks = talks.select("*", (F.col("conv_id") - F.col("conv_id") % BORROW_FROM).alias("lender"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_BORROWED + 1)).alias("h"))
    lent = talks.select(F.col("conv_id").alias("lender"), F.col("first").alias("lent_first"), F.col("n").alias("lent_n"))
    talks = talks.join(lent, "lender", "left")
    borrowed = F.least("h", F.coalesce("lent_n", F.lit(0)))
    talks = staged(talks.select("conv_id", "first", "h", "lender", "lent_first", borrowed.alias("borrowed"),
                                (borrowed + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "talks")
    kept = own.join(talks, "conv_id").withColumn("place", F.col("rank") - F.col("first") + 1 - F.col("h")).where("place > 0")
    kept = kept.select("conv_id", (F.col("place") + F.col("borrowed")).alias("place"), "turns", "key", "words")
    wants = talks.where("borrowed > 0").select("conv_id", "turns", F.explode(F.sequence(
        F.col("lent_first"), F.col("lent_first") + F.col("borrowed") - 1)).alias("rank"), "lent_first")
    lent = wants.join(own.select("rank", "key", "words"), "rank").select(
        "conv_id", (F.col("rank") - F.col("lent_first") + 1).alias("place"), "turns", "key", "words")
    return kept.unionByName(lent), talks.select("conv_id", "turns")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with p1, p2 (hash of the sequence up to here), q1, q2 (up to
    the turn before) and upto (words up to here)."""
    turns = turns.withColumn("f1", F.xxhash64("place", "key")).withColumn("f2", F.xxhash64("key", "place")).drop("key")
    turns = turns.withColumn("part", F.floor((F.col("place") - 1) / WINDOW_TURNS))
    so_far = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    out = turns.select("conv_id", "place", "turns", "words", "f1", "f2", "part", F.bit_xor("f1").over(so_far).alias("p1"),
                       F.bit_xor("f2").over(so_far).alias("p2"), F.sum("words").over(so_far).alias("upto"))
    parts = turns.where(F.col("turns") > WINDOW_TURNS).groupBy("conv_id", "part").agg(
        F.bit_xor("f1").alias("x1"), F.bit_xor("f2").alias("x2"), F.sum("words").alias("xw"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", *[f.over(before).alias(c) for c, f in (
        ("x1", F.bit_xor("x1")), ("x2", F.bit_xor("x2")), ("xw", F.sum("xw")))]).where("part > 0")
    later = out.where("part > 0").join(parts, ["conv_id", "part"])
    later = later.withColumn("p1", F.col("p1").bitwiseXOR(F.col("x1"))).withColumn("p2", F.col("p2").bitwiseXOR(F.col("x2")))
    later = later.withColumn("upto", F.col("upto") + F.col("xw")).drop("x1", "x2", "xw")
    out = out.where("part = 0").unionByName(later)
    return out.select("conv_id", "place", "turns", "words", "upto", "p1", "p2",
                      F.col("p1").bitwiseXOR(F.col("f1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("f2")).alias("q2"))


# ---------------------------------------------------------------- shards
class Shard:
    """The trie of some sorted lists of chains. Node 0 is the root."""

    def __init__(self, paths: dict[str, np.ndarray], lengths: np.ndarray, sums: dict[str, np.ndarray], total: int, root_m: int):
        n_rows, starts = len(lengths), np.concatenate([[0], np.cumsum(lengths)])
        row = np.repeat(np.arange(n_rows), lengths)
        column = np.arange(len(row)) - starts[row]
        same = np.zeros(len(row), bool)
        may = (row > 0) & (column < lengths[row - 1]) if len(row) else same
        twin = starts[row[may] - 1] + column[may]
        same[may] = (paths["p1"][may] == paths["p1"][twin]) & (paths["p2"][may] == paths["p2"][twin])
        self.new = np.flatnonzero(~same)  # the entry that opens each node, in preorder
        nodes = len(self.new) + 1
        number = np.zeros(len(row), np.int64)
        number[self.new] = np.arange(1, nodes)
        by_column = np.argsort(column, kind="stable")
        opened = np.maximum.accumulate(np.where(same[by_column], 0, np.arange(len(row)))) if len(row) else by_column
        self.node_of = np.empty(len(row), np.int64)
        self.node_of[by_column] = number[by_column][opened]
        self.paths, self.starts, self.row, self.column = paths, starts, row, column
        self.m, self.n, self.own = (np.concatenate([[r], paths[c][self.new]]) for c, r in (("m", root_m), ("n", total), ("own", 0)))
        self.parent = np.zeros(nodes, np.int64)
        deeper = self.new[column[self.new] > 0]
        self.parent[number[deeper]] = self.node_of[deeper - 1]

        shared = np.bincount(row[same], minlength=n_rows)
        closes = np.concatenate([[0], lengths[:-1]]) - shared if n_rows else shared
        opens = np.concatenate([[0], np.arange(1, nodes) + np.cumsum(closes)[row[self.new]]]).astype(np.int64)
        bits = np.zeros(2 * nodes, bool)
        bits[opens] = True
        tree = Parentheses(bits)
        close = tree.find_close(opens)
        end = tree.rank_open(close)  # the subtree of a node is its preorder numbers up to here
        # sums handed over from finished shards, per node; the root's come first in each list
        given = {}
        for c in _SUMS:
            lists = sums[c]
            at_root = starts[:-1] + np.arange(n_rows)
            inner = np.ones(len(lists), bool)
            inner[at_root] = False
            given[c] = np.zeros(nodes, np.int64)
            np.add.at(given[c], self.node_of, lists[inner])
            given[c][0] += lists[at_root].sum()
        pair = bits & ~np.append(bits[1:], True)  # "()": opened and closed at once
        leaf = np.zeros(len(bits) + 1, np.int64)
        leaf[1:] = np.cumsum(pair)
        childless = tree.rank_open(np.flatnonzero(pair))
        not_leaf = np.zeros(nodes + 1, np.int64)
        not_leaf[1:] = np.cumsum(np.bincount(childless, weights=given["kids"][childless] > 0, minlength=nodes).astype(np.int64))

        def subtree(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])
            return upto[end] - upto[:-1]

        self.leaves = leaf[close] - leaf[opens] - (not_leaf[end] - not_leaf[:-1]) + subtree(given["leaves"])
        self.saved = subtree(self.own + given["saved"])
        self.finished = subtree(given["members"]) == self.n
        children = np.bincount(self.parent[1:][self.finished[1:]], minlength=nodes)
        self.kids = given["kids"] + children
        # what an unfinished node hands over: its own sums and its finished children's
        self.over = {"kids": self.kids, "members": given["members"], "leaves": given["leaves"], "saved": given["saved"]}
        top = np.flatnonzero(self.finished & ~self.finished[self.parent])
        top = top[top > 0]
        for c, values in (("leaves", self.leaves), ("saved", self.saved), ("members", self.n)):
            np.add.at(self.over[c], self.parent[top], values[top])

    def spines(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(entries, nodes) of every path to an unfinished node without an
        unfinished child: at most two. ``nodes`` has the root first."""
        open_ = np.flatnonzero(~self.finished)
        tips = np.setdiff1d(open_, self.parent[open_[open_ > 0]])
        for tip in tips:
            if tip == 0:
                yield np.empty(0, np.int64), np.zeros(1, np.int64)
            else:
                e = self.new[tip - 1]
                entries = np.arange(self.starts[self.row[e]], e + 1)
                yield entries, np.concatenate([[0], self.node_of[entries]])


def _lists(values: np.ndarray, lengths: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


_OUT = ", ".join([f"{c} long" for c in ("m", "n", "up", "n_leaves", "saved", "kids")]
                 + [f"path {_PATH}"] + [f"w_{c} array<long>" for c in _SUMS])


def _run_shards(total: int, root_m: int, shard_chains: int, shard_rows: int):
    def finished(shard: Shard) -> pa.RecordBatch:
        of = np.flatnonzero(shard.finished)
        n = np.where(of == 0, 0, shard.n[of])  # the root is a chain of its own
        up = pa.array(shard.m[shard.parent[of]], mask=of == 0)
        known = [pa.array(shard.m[of]), pa.array(n), up, pa.array(shard.leaves[of]), pa.array(shard.saved[of]), pa.array(shard.kids[of])]
        return known + [pa.nulls(len(of), path_type)] + [pa.nulls(len(of), pa.list_(pa.int64()))] * len(_SUMS)

    def handed_over(shard: Shard) -> list[pa.Array]:
        told, entries, nodes = np.zeros(len(shard.n), bool), [], []
        for e, v in shard.spines():
            entries.append(e)
            nodes.append(np.where(told[v], -1, v))  # each sum goes along once
            told[v] = True
        k, where = len(entries), np.concatenate(entries) if entries else np.empty(0, np.int64)
        which = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        path = pa.StructArray.from_arrays([pa.array(shard.paths[c][where]) for c in ("p1", "p2", "m", "n", "own")],
                                          fields=list(path_type.value_type))
        ends = pa.array(np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int32))
        sums = [_lists(np.where(which < 0, 0, shard.over[c][which]), [len(v) for v in nodes]) for c in _SUMS]
        return [pa.nulls(k, pa.int64())] * 6 + [pa.ListArray.from_arrays(ends, path, type=path_type)] + sums

    entry = pa.struct([pa.field(c, pa.int64()) for c in ("p1", "p2", "m", "n", "own")])
    path_type = pa.list_(entry)
    names = ["m", "n", "up", "n_leaves", "saved", "kids", "path", *[f"w_{c}" for c in _SUMS]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = chains = 0

        def close() -> Iterator[pa.RecordBatch]:
            paths = {c: np.concatenate([h[0][c] for h in held]) for c in ("p1", "p2", "m", "n", "own")}
            sums = {c: np.concatenate([h[2][c] for h in held]) for c in _SUMS}
            shard = Shard(paths, np.concatenate([h[1] for h in held]), sums, total, root_m)
            for columns in (finished(shard), handed_over(shard)):
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, max(shard_rows, min(4096, batch.num_rows)))
                at += part.num_rows
                path = part.column("path")
                lengths = path.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                flat = path.flatten()
                paths = {c: flat.field(k).to_numpy(zero_copy_only=False) for k, c in enumerate(("p1", "p2", "m", "n", "own"))}
                if "members" in part.schema.names:  # distinct sequences: nothing is finished yet
                    zero = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
                    members = zero.copy()
                    members[np.cumsum(lengths + 1) - 1] = part.column("members").to_numpy(zero_copy_only=False)
                    sums = {"leaves": zero, "saved": zero, "kids": zero, "members": members}
                else:
                    sums = {c: part.column(f"w_{c}").flatten().to_numpy(zero_copy_only=False) for c in _SUMS}
                held.append((paths, lengths, sums))
                rows, chains = rows + len(lengths), chains + int(lengths.sum())
                if rows >= shard_rows and chains >= shard_chains:
                    yield from close()
                    held, rows, chains = [], 0, 0
        if held:
            yield from close()
    return run


def chain_totals(paths: DataFrame, total: int, root_m: int, shard_chains: int = SHARD_CHAINS,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(m, n, up, n_leaves, saved, kids) of every chain, and of the root as
    (its m, 0), from (path, members) with one row per distinct sequence."""
    spark = paths.sparkSession
    done, todo, parts = None, paths, int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        dealt = todo.repartitionByRange(parts, "path") if parts > 1 else todo.repartition(1)
        out = staged(dealt.sortWithinPartitions("path").mapInArrow(
            _run_shards(total, root_m, shard_chains, shard_rows), _OUT), "shards")
        ready = out.where("m is not null").select("m", "n", "up", "n_leaves", "saved", "kids")
        done = ready if done is None else done.unionByName(ready)
        todo = out.where("path is not null").select("path", *[f"w_{c}" for c in _SUMS])
        left = todo.count()
        if not left:
            return done
        parts = -(-left // MERGE_ROWS)


# ---------------------------------------------------------------- members
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (p1, p2, place, conv_id): runs of ids, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "p1", "p2")]
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        change = np.ones(len(ids), bool)
        change[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]) | (key[2][1:] != key[2][:-1])
        first = np.flatnonzero(change)
        cuts = np.unique(np.concatenate([first, *[np.arange(a, b, IDS_A_PIECE) for a, b in
                                                  zip(first, np.append(first[1:], len(ids))) if b - a > IDS_A_PIECE]]))
        text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, np.append(cuts[1:], len(ids)))]
        yield pa.RecordBatch.from_arrays([*[pa.array(k[cuts]) for k in key], pa.array(ids[cuts]), pa.array(text)],
                                         names=["place", "p1", "p2", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, one after another."""
    held, so_far = None, None

    def row(key, digest):
        return pa.RecordBatch.from_arrays([pa.array([k]) for k in (*key, digest.hexdigest())],
                                          names=["place", "p1", "p2", "ends_sha256"])
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("place", "p1", "p2")]))
        out = []
        for key, ids in zip(keys, batch.column("ids")):
            if key != held:
                if held is not None:
                    out.append((*held, so_far.hexdigest()))
                held, so_far = key, hashlib.sha256()
                so_far.update(ids.as_py().encode())
            else:
                so_far.update(b"," + ids.as_py().encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["place", "p1", "p2", "ends_sha256"])
    if held is not None:
        yield row(held, so_far)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(place, p1, p2, ends_sha256) from one row per conversation and its last
    node. A node with any number of members is sorted over several tasks, and
    only its joined pieces, read as a stream, come together."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["p1", "p2", "place", "conv_id"]
    pieces = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "place long, p1 long, p2 long, first long, ids string")
    key = ["p1", "p2", "place"]
    return pieces.repartition(parts, *key).sortWithinPartitions(*key, "first").mapInArrow(
        _digests, "place long, p1 long, p2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame, shard_chains: int = SHARD_CHAINS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns, whatever
    their names, are left out. See ``rebuilt_turns`` for NULLs, ties and
    repeated rows. An empty text is a turn without words. A conversation may
    have any number of turns. No conversations give no rows."""
    turns, talks = rebuilt_turns(conversations)
    rows = staged(_prefixes(turns), "prefixes")
    whole = talks.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("m")).first()
    total, root_m = int(whole["n"]), whole["m"]
    nodes = rows.groupBy("place", "p1", "p2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("m"), F.min("words").alias("words"), F.min("upto").alias("upto"))
    nodes = staged(nodes, "nodes")
    before = F.col("upto") - F.col("words")
    chains = staged(nodes.groupBy("m", "n").agg(
        F.min("place").alias("top"), F.max("place").alias("bottom"), ((F.col("n") - 1) * F.sum("words")).alias("own"),
        F.min_by(F.struct("p1", "p2", before.alias("before")), "place").alias("head")), "chains")

    none = talks.where("turns = 0").select(F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("p1"),
                                           F.lit(0).cast("long").alias("p2"), "conv_id")
    ends = rows.where("place = turns").select("place", "p1", "p2", "conv_id").unionByName(none)
    sequences = ends.groupBy("place", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("members"))
    sequences = sequences.select("conv_id", "members", F.col("place").alias("size"))
    heads = chains.select(F.col("top").alias("place"), F.col("head.p1").alias("p1"), F.col("head.p2").alias("p2"), "m", "n", "own")
    passed = rows.select("conv_id", "place", "p1", "p2").join(sequences.where("size > 0").select("conv_id"), "conv_id", "left_semi")
    passed = passed.join(heads, ["place", "p1", "p2"]).groupBy("conv_id").agg(  # at most the root of twice the rows
        F.sort_array(F.collect_list(F.struct("place", "p1", "p2", "m", "n", "own"))).alias("path"))
    passed = passed.withColumn("path", F.transform("path", lambda x: F.struct(*[x[c].alias(c) for c in ("p1", "p2", "m", "n", "own")])))
    paths = sequences.join(passed, "conv_id", "left").select(
        F.coalesce("path", F.array().cast(_PATH)).alias("path"), "members")
    totals = chain_totals(paths, total, root_m or 0, shard_chains, shard_rows)

    about = totals.join(chains.select("m", "n", "top", "bottom", "head.before"), ["m", "n"], "left")
    root = nodes.limit(0).select("place", "p1", "p2", "n", "m", "words", "upto")
    if total:
        root = nodes.sparkSession.createDataFrame([(0, 0, 0, total, root_m, 0, 0)], root.schema)
    every = nodes.select(*root.columns).unionByName(root).withColumn("chain", F.when(F.col("place") > 0, F.col("n")).otherwise(F.lit(0)))
    joined = every.join(about.withColumnRenamed("n", "chain"), ["m", "chain"])
    joined = joined.join(ends_digests(ends), ["place", "p1", "p2"], "left")
    inside = F.col("place") > F.col("top")
    long: dict[str, Column] = {
        "conv_id": F.col("m"), "depth": F.col("place"),
        "parent_conv_id": F.when(inside, F.col("m")).otherwise(F.col("up")), "n_convs": F.col("n"),
        "n_children": F.when(F.col("place") < F.col("bottom"), F.lit(1)).otherwise(F.col("kids")), "n_leaves": F.col("n_leaves"),
        "saved_tokens": F.col("saved") - (F.col("n") - 1) * (before - F.coalesce("before", F.lit(0)))}
    return joined.select(*[v.cast("long").alias(c) for c, v in long.items()],
                         F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
