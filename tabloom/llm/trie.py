"""Prefix trie of conversations, by balanced parentheses.

A conversation is a path of turns; a node of the trie is a distinct run of first turns. Paths are
sorted and cut into shards of neighbouring paths, and each shard encodes the trie of its paths as
balanced parentheses: the end of a subtree gives its members, leaves and saved words as differences
of cumulative arrays. Nodes that neighbouring shards share lie on the path of a shard's first or
last conversation, its spines. Their parts are sums in which every node is counted by one shard
only, so merging them is an addition. A first turn, or a whole conversation, that very many share
is thus spread over many shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, written
from .parentheses import Parentheses

DIGITS = 32  # hexadecimal digits of a turn's digest in a path
TURNS_PER_SHARD = 500_000
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PARTS = NODE + ", shard int, node_id string, parent_id string, ends string"


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, own): the turns of each conversation in order, as structs of digest and number of words.

    Order is by `turn`, missing first; turns at the same place are ordered by the digest of role and
    text, so repeated rows are turns of their own. A missing role or text is empty. Rows without a
    conv_id belong to no conversation. A conversation's digests, not its texts, are held by one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), words.alias("words")).alias("t")
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    own = F.transform("ts", lambda t: F.struct(F.substring(t["digest"], 1, DIGITS).alias("digest"), t["words"].alias("words")))
    return lists.select("conv_id", own.alias("own"))


def rebuilt_paths(lists: DataFrame, block: int = 20, shared: int = 4) -> DataFrame:
    """(conv_id, path): conversation c begins with the first h turns of c - c % `block`, h = crc32(c) % `shared`.

    Its own turns after its first h follow. A base that is short or absent lends what it has.
    """
    lists = written(lists, "turns")
    base = lists.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, max(shared - 1, 1)).alias("lent")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    rows = lists.select("*", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), h.alias("h"))
    rows = rows.join(base, "base", "left")
    lent = F.coalesce("lent", F.slice("own", 1, F.lit(0)))
    path = F.concat(F.slice(lent, F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own")))
    return rows.select("conv_id", path.alias("path"))


def plain_paths(lists: DataFrame) -> DataFrame:
    """(conv_id, path): the conversations as they are."""
    return lists.withColumnRenamed("own", "path")


def sharded(paths: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """(shard, conv_id, path, words, before, after), written: neighbouring paths share a shard.

    `before` is how many first turns the shard's first path has in common with the path that comes
    before it in the shard before (-1: there is none), `after` those its last has in common with the next.
    """
    spark = paths.sparkSession
    keyed = paths.select(
        "conv_id", F.array_join(F.transform("path", lambda t: t["digest"]), "").alias("path"), F.col("path.words").alias("words")
    )
    keyed = written(keyed, "paths")
    turns = keyed.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // turns_per_shard))
    dealt = keyed.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id())
    dealt = written(dealt, "shards")
    # one row per shard
    order = Window.orderBy("shard")
    ends = dealt.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    ends = ends.withColumns({"previous": F.lag("last").over(order), "next": F.lead("first").over(order)})
    bounds = ends.select("shard", _common("previous", "first").alias("before"), _common("last", "next").alias("after"))
    # 12 bytes per shard, and their number follows turns_per_shard
    return dealt.join(F.broadcast(bounds), "shard")


def _common(a: str, b: str) -> Column:
    """How many first turns two paths have in common; -1 if there is but one path."""
    one, two = (F.array_remove(F.split(F.col(c), rf"(?<=\G.{{{DIGITS}}})"), "") for c in (a, b))
    same = F.zip_with(one, two, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(same, False)
    return F.coalesce(F.when(differ == 0, F.size(same)).otherwise(differ - 1).cast("int"), F.lit(-1))


class Shard:
    """The trie of sorted paths, encoded as balanced parentheses."""

    def __init__(self, conv_ids: np.ndarray, paths: list[str], words: np.ndarray):
        self.conv_ids, self.paths = conv_ids, paths
        self.size = np.array([len(p) // DIGITS for p in paths])
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        digests = np.array("".join(paths).encode(), f"S{DIGITS * max(self.at[-1], 1)}").reshape(1).view(f"S{DIGITS}")
        turn = np.unique(digests, return_inverse=True)[1]
        common = self._common(turn)
        opens = self.size - common
        closes = np.concatenate([[0], self.size[:-1] - common[1:]])
        # the root, then for each path: close down to what it shares with the one before, open the rest
        runs = np.stack([closes, opens], 1).ravel()
        bits = np.repeat(np.tile([False, True], len(paths)), runs)
        self.tree = Parentheses(np.concatenate([[True], bits, np.zeros(self.size[-1] + 1, bool)]))
        self.arrive = np.cumsum(closes + opens)  # position of the last bit up to each path
        self.owner = np.concatenate([[0], np.repeat(np.arange(len(paths)), opens)])  # first member of each node
        self.depth = self.tree.excess[self.tree.opens] - 1
        last = self.at[self.owner] + self.depth - 1
        self.words = np.where(self.depth > 0, np.concatenate([words, [0]])[last], 0)

    def _common(self, turn: np.ndarray) -> np.ndarray:
        """How many first turns each path shares with the one before."""
        common, go, d = np.zeros(len(self.size), int), np.arange(1, len(self.size)), 0
        while len(go):
            go = go[(self.size[go] > d) & (self.size[go - 1] > d)]
            go = go[turn[self.at[go] + d] == turn[self.at[go - 1] + d]]
            common[go] += 1
            d += 1
        return common

    def families(self) -> None:
        """Members, parents, children, leaves and the two sums of each node, in preorder."""
        tree, n = self.tree, len(self.depth)
        close = tree.find_close(tree.opens)
        self.until = tree.opened[close]  # subtree: nodes from itself to before this one
        self.members = np.searchsorted(self.arrive, close) - self.owner
        self.on_last = self.owner + self.members == len(self.paths)
        self.leaves = tree.pairs[close] - tree.pairs[tree.opens] + ~tree.bits[tree.opens + 1]
        ranges = np.stack([self.owner, self.owner + self.members], 1).ravel()
        self.least = np.minimum.reduceat(np.concatenate([self.conv_ids, [0]]), ranges)[::2]
        keys = np.sort(self.depth * n + np.arange(n))  # the parent is the last node before of the level above
        above = np.searchsorted(keys, (self.depth - 1) * n + np.arange(n)) - 1
        self.parent = np.where(self.depth > 0, keys[above] % n, -1)
        self.end_node = tree.opened[self.arrive] - 1  # where each path ends
        self.ends_at = np.searchsorted(self.end_node, np.arange(n))
        self.ends = np.bincount(self.end_node, minlength=n)

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.until] - sums[:-1]

    def spine(self, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes other shards have, too; which of them an earlier shard has."""
        earlier = (self.owner == 0) & (self.depth <= before)
        return earlier | (self.on_last & (self.depth <= after)), earlier

    def rows(self, shard: int, before: int, after: int) -> dict[str, list]:
        """The finished nodes, and this shard's part of the nodes on its spines."""
        self.families()
        shared, earlier = self.spine(before, after)
        own = ~earlier
        # the last path's node is no leaf here if a later shard has the same node: that one will tell
        leaves = self.leaves - self.on_last if after == self.size[-1] else self.leaves
        # (members - 1) * words, where the 1 is counted by the first shard that has the node
        saved = self.below(self.members * self.words - own * self.words)
        children = np.bincount(self.parent[1:][own[1:]], minlength=len(self.depth))
        node_id, ends, sha = self._names(shared), [None] * len(own), [None] * len(own)
        for k in np.flatnonzero(self.ends > 0):
            a = self.ends_at[k]
            text = ",".join(map(str, self.conv_ids[a : a + self.ends[k]].tolist()))
            if shared[k]:
                ends[k] = text
            else:
                sha[k] = hashlib.sha256(text.encode()).hexdigest()
        parent = self.parent.tolist()
        least = self.least.tolist()
        return {
            "conv_id": least,
            "depth": self.depth.tolist(),
            "parent_conv_id": [None if p < 0 or shared[p] else least[p] for p in parent],
            "n_convs": self.members.tolist(),
            "n_children": children.tolist(),
            "n_leaves": leaves.tolist(),
            "saved_tokens": saved.tolist(),
            "ends_sha256": [s or NOTHING for s in sha],
            "shard": [shard] * len(parent),
            "node_id": node_id,
            "parent_id": [None if p < 0 else node_id[p] for p in parent],
            "ends": ends,
        }

    def _names(self, shared: np.ndarray) -> list[str | None]:
        """A digest of the whole prefix for each node on a spine, which is the same in all shards."""
        names: list[str | None] = [None] * len(shared)
        running: dict[int, object] = {}
        for k in np.flatnonzero(shared):  # parents come first, and are on the spine, too
            p, d = self.parent[k], self.depth[k]
            state = running[p].copy() if p >= 0 else hashlib.sha256()
            if p >= 0:
                state.update(self.paths[self.owner[k]][(d - 1) * DIGITS : d * DIGITS].encode())
            running[k], names[k] = state, f"{d}-{state.hexdigest()}"
        return names


def _opened(group: pa.Table) -> tuple[Shard, int, int, int]:
    group = group.sort_by([("path", "ascending"), ("conv_id", "ascending")])
    words = group["words"].combine_chunks().flatten().to_numpy()
    one = (group[c][0].as_py() for c in ("shard", "before", "after"))
    return Shard(group["conv_id"].to_numpy(), group["path"].to_pylist(), words), *one


def encoded(paths: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """(shard, nodes, bits): each shard's trie as balanced parentheses, packed, the first bit first."""
    ship_package(paths.sparkSession)

    def encode(group: pa.Table) -> pa.Table:
        trie, shard, *_ = _opened(group)
        held = [[shard], [len(trie.depth)], [np.packbits(trie.tree.bits).tobytes()]]
        return pa.table([pa.array(x, t) for x, t in zip(held, (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["shard", "nodes", "bits"])

    return sharded(paths, turns_per_shard).groupBy("shard").applyInArrow(encode, "shard int, nodes long, bits binary")


def _streamed_digests(chunks: DataFrame) -> DataFrame:
    """(node_id, ends_sha256): SHA-256 of the shards' lists of ids, one after the other, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
        for name, same in groupby(rows, lambda r: r[0]):
            state, comma = hashlib.sha256(), b""
            for _, text in same:
                state.update(comma + text.encode())
                comma = b","
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], ["node_id", "ends_sha256"])

    ordered = chunks.select("node_id", "shard", "ends").repartition("node_id").sortWithinPartitions("node_id", "shard")
    return ordered.mapInArrow(run, "node_id string, ends_sha256 string")


def nodes(paths: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of `paths`, the root included; an empty table has no trie.

    conv_id: the smallest member; depth; parent_conv_id; n_convs: members; n_children; n_leaves in
    the subtree; saved_tokens: over the subtree, (members - 1) times the words of a node's last turn;
    ends_sha256: SHA-256 of the ids of the conversations that end here, ascending, joined by commas.
    A conversation without turns ends at the root. Equal conversations, however many, are members of
    the same nodes. The ids that end at a shared node are hashed as a stream.
    """
    ship_package(paths.sparkSession)

    def build(group: pa.Table) -> pa.Table:
        trie, shard, before, after = _opened(group)
        return pa.table(trie.rows(shard, before, after), schema=PARTS_ARROW)

    parts = written(sharded(paths, turns_per_shard).groupBy("shard").applyInArrow(build, PARTS), "nodes")
    columns = [c.split()[0] for c in NODE.split(", ")]
    spine = parts.where("node_id is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = spine.groupBy("node_id", "depth", "parent_id").agg(F.min("conv_id").alias("conv_id"), *sums)
    merged = merged.join(_streamed_digests(spine.where("ends is not null")), "node_id", "left")
    merged = written(merged.fillna(NOTHING, ["ends_sha256"]), "spines")
    parents = merged.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    shared = merged.join(parents, "parent_id", "left").select(*columns)
    whole = parts.where("node_id is null")
    hanging = whole.where("parent_id is not null").drop("parent_conv_id").join(parents, "parent_id", "left")
    inner = whole.where("parent_id is null")
    return shared.unionByName(hanging.select(*columns)).unionByName(inner.select(*columns))


PARTS_ARROW = pa.schema([
    (name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind])
    for name, kind in (c.split() for c in PARTS.split(", "))
])
