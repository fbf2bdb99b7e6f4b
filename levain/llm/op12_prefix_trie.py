"""The prefix trie of conversations, by vertical bitmaps.

A conversation is its turns in order; every distinct sequence of first d turns is a node of depth d, from the
textless root.  For each node: its members (conversations that start with it) and those that end there, its children, the
leaves below, and the tokens that sharing it saves.

Rebuilding (optional).  ``rebuilt`` first joins conversations that were cut from one session: the first h turns of
the conversation ``id - id % group`` come before the conversation's own turns after its first h, with h = crc32(id) % (group heads + 1).

Method.  Texts become 128-bit digests at once; only digests and word counts travel.  Conversations are numbered by
rising id and dealt to shards of SHARD consecutive ones, positions to bands of BAND turns.  A task takes one band of one
shard and indexes (position, turn) to the bitset of its conversations.  From each parent, depth first: the lowest
member that is not yet placed names a turn of the next position, the parent's bitset and that turn's posting intersect to the
child, whose popcount, smallest member and end list follow from the bits.  Bands start from the prefixes that
their conversations have read so far (a running 128-bit digest of the turns names each node), so a long
conversation is many small tasks.

Merging.  A node's popcounts add up over shards and its smallest member is the smallest of them.  As the smallest member of a
prefix owns it and then all its own deeper prefixes, each node is counted once, in its owner; sums over a subtree are sums
over the members of what each owns from that depth on (a running sum along a conversation), added up per node with
partial aggregates.  End lists stay in order, as shards are ranges of ids; one task digests a node's lists as a stream,
chunk by chunk, since SHA-256 has to read them in order.

Cases.  A null role or text is empty.  Null turn numbers come first; turns with the same number are ordered by role, then by
the text's digest; repeated rows are turns of their own.  Rows with a null conversation id belong to no conversation.  A conversation
whose turns all fall away stays a member of the root.  No conversation gives no row, not even a root.  Long conversations
are ordered and summed by windows, which spill; texts of any length are only digested and counted.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.llm.common import prepare, written

#: Conversations of a shard, turns of a band.
SHARD, BAND = 2048, 64
WORD = r"[^\x20\x09-\x0D]+"
NODE = "a long, b long, depth int, n long, conv_id long, inner boolean, words long, shard long, ends string"


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, key, words): the turns of each conversation, from position 1, with digest and words of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text))).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "key", "words")


def conversations(own: DataFrame) -> DataFrame:
    """(conv_id, n, slot): the conversations with their turns counted, numbered by rising id: ``slot`` rises with the id."""
    found = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    return written(found.repartitionByRange("conv_id").sortWithinPartitions("conv_id").withColumn("slot", F.monotonically_increasing_id()), "conversations")


def rebuilt(own: DataFrame, convs: DataFrame, group: int = 20, heads: int = 3) -> tuple[DataFrame, DataFrame]:
    """The turns and conversations after rebuilding: each takes up to ``heads`` first turns of its group's first conversation."""
    base = F.col("conv_id") - F.col("conv_id") % group
    first = own.filter((F.col("conv_id") == base) & (F.col("pos") <= heads)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("head"))  # ``heads`` at most
    plan = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % (heads + 1)).cast("int")).withColumn("base", base).join(first, "base", "left")
    plan = plan.withColumn("head", F.slice(F.coalesce("head", F.array().cast(first.schema["head"].dataType)), F.lit(1), F.col("h")))
    plan = written(plan.select("conv_id", "slot", "h", "head", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "rebuilt")
    taken = plan.select("conv_id", F.inline("head"))
    kept = own.join(plan.select("conv_id", "h", F.size("head").alias("taken")), "conv_id").filter("pos > h")
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    return taken.unionByName(kept), plan.select("conv_id", "slot", "n")


def _paths(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The turns with ``slot``, ``n``, and the names of the nodes they lead to (a, b) and come from (pa, pb)."""
    along = Window.partitionBy("conv_id").orderBy("pos")
    rows = rows.join(convs, "conv_id")
    for name, parts in (("a", ("pos", "key")), ("b", ("key", "pos"))):
        mixed = F.xxhash64(F.lit(name), *parts)
        rows = rows.withColumn(name, F.bit_xor(mixed).over(along)).withColumn(f"p{name}", F.col(name).bitwiseXOR(mixed))
    return rows


class Bitmaps:
    """The index of one band of one shard: (position, turn) to the bitset of its conversations."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows
        self.postings: dict[tuple[int, bytes], int] = {}
        self.at: dict[tuple[int, int], int] = {}
        self.has: dict[int, int] = {}
        self.last: dict[int, int] = {}
        for i, (bit, pos, n, key) in enumerate(zip(rows["bit"].tolist(), rows["pos"].tolist(), rows["n"].tolist(), rows["key"], strict=True)):
            one = 1 << bit
            self.postings[pos, key] = self.postings.get((pos, key), 0) | one
            self.has[pos] = self.has.get(pos, 0) | one
            self.at[bit, pos] = i
            if pos == n:
                self.last[pos] = self.last.get(pos, 0) | one
        self.keys = rows["key"].tolist()

    def roots(self) -> list[tuple[int, int]]:
        """(bitset, position before the band) of each prefix that the band's conversations have read so far."""
        start, first = {}, int(self.rows["pos"].min())
        for bit, pos, pa_, pb in zip(*(self.rows[c].tolist() for c in ("bit", "pos", "pa", "pb")), strict=True):
            if pos == first:
                start[pa_, pb] = start.get((pa_, pb), 0) | 1 << bit
        return [(members, first - 1) for members in start.values()]

    def nodes(self) -> Iterator[tuple[int, int, int, int]]:
        """(row of the smallest member, position, members, those that end there), depth first."""
        stack = self.roots()
        while stack:
            parent, pos = stack.pop()
            pos += 1
            rest = parent & self.has.get(pos, 0)
            while rest:
                row = self.at[(rest & -rest).bit_length() - 1, pos]
                child = parent & self.postings[pos, self.keys[row]]
                rest &= ~child
                ends = child & self.last.get(pos, 0)
                yield row, pos, child, ends
                if child != ends:
                    stack.append((child, pos))


def nodes_of_band(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one band of one shard, with their part of members and end lists."""
    rows = rows.reset_index(drop=True)
    ids = dict(zip(rows["bit"].tolist(), rows["conv_id"].tolist(), strict=True))
    out = []
    for row, pos, child, ends in Bitmaps(rows).nodes():
        out.append((row, pos, child.bit_count(), child != ends, ",".join(str(ids[bit]) for bit in _bits(ends)) if ends else None))
    at = [o[0] for o in out]
    of = rows.iloc[at]
    return pd.DataFrame({"a": of["a"].to_numpy(), "b": of["b"].to_numpy(), "depth": [o[1] for o in out], "n": [o[2] for o in out], "conv_id": of["conv_id"].to_numpy(),
                         "inner": [o[3] for o in out], "words": of["words"].to_numpy(), "shard": of["shard"].to_numpy(), "ends": pd.Series([o[4] for o in out], dtype="object")})


def _bits(x: int) -> Iterator[int]:
    """The places of the set bits, rising."""
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _digests(lists: DataFrame) -> DataFrame:
    """(a, b, depth, ends_sha256): SHA-256 of each node's end lists, comma-joined in the order of shards, read as a stream."""
    names = ["a", "b", "depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, hashlib.sha256()
        for x in batches:
            done = []
            for *node, text in zip(*(x.column(c).to_pylist() for c in [*names, "ends"]), strict=True):
                if node == now:
                    sha.update(b",")
                else:
                    done += [(*now, sha.hexdigest())] if now else []
                    now, sha = node, hashlib.sha256()
                sha.update(text.encode())
            yield from _batch(done)
        yield from _batch([(*now, sha.hexdigest())] if now else [])

    def _batch(done: list[tuple]) -> Iterator[pa.RecordBatch]:
        if done:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)], [*names, "ends_sha256"])

    rows = lists.repartition(*names).sortWithinPartitions(*names, "shard").select(*names, "ends")
    return rows.mapInArrow(run, "a long, b long, depth int, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The nodes of the conversations ``convs`` (conv_id, slot, n) with the turns ``rows`` (conv_id, pos from 1, key, words): (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    prepare(rows.sparkSession)
    low = F.col("slot").bitwiseAND((1 << 33) - 1)  # within a part of the numbering; parts are far apart
    place: Column = F.shiftright("slot", 33) * (1 << 33) + F.floor(low / shard)
    paths = written(_paths(rows, convs).withColumn("shard", place).withColumn("bit", (low % shard).cast("int")).drop("slot"), "paths")
    bands = paths.groupBy("shard", F.floor((F.col("pos") - 1) / band).alias("band"))
    parts = written(bands.applyInPandas(nodes_of_band, NODE), "trie-parts")

    nodes = parts.groupBy("a", "b", "depth").agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("inner").alias("inner"))
    along = Window.partitionBy("conv_id").orderBy("pos")
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    root = convs.agg(F.min("conv_id")).scalar()
    x = paths.select("conv_id", "pos", "a", "b", "words").join(nodes.withColumnRenamed("depth", "pos"), ["a", "b", "pos"])
    x = x.withColumn("owns", F.col("conv_id") == F.col("owner")).withColumn("saves", F.when(F.col("owns"), (F.col("n_convs") - 1) * F.col("words")).otherwise(0))
    x = x.withColumn("leaf", (F.col("owns") & ~F.col("inner")).cast("long"))
    below = lambda c: F.sum(c).over(every) - F.sum(c).over(along) + F.col(c)  # noqa: E731  what the conversation owns from here on
    x = x.select("a", "b", F.col("pos").alias("depth"), "owner", "n_convs", "owns", "leaf", "saves", F.coalesce(F.lag("owner").over(along), root).alias("parent"),
                 F.coalesce(F.lead("owns").over(along), F.lit(False)).alias("next"), below("leaf").alias("leaves"), below("saves").alias("saved"))
    found = x.groupBy("a", "b", "depth").agg(
        F.min("owner").alias("conv_id"), F.min("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.count_if("next").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("own_leaf"), F.sum("saves").alias("own_saves"))
    found = written(found, "trie-nodes")
    top = found.select(F.lit(None).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n"), (F.col("depth") == 1).cast("long").alias("child"), "own_leaf", "own_saves").unionByName(
        convs.select("conv_id", F.lit(1).cast("long").alias("n"), *(F.lit(0).cast("long").alias(c) for c in ("child", "own_leaf", "own_saves"))))
    top = top.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("child").alias("n_children"), F.greatest(F.sum("own_leaf"), F.lit(1)).alias("n_leaves"), F.sum("own_saves").alias("saved_tokens"))
    top = top.filter("n_convs > 0").select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "*")

    silent = convs.filter("n = 0").groupBy(place.alias("shard")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ends"))  # a shard's at most
    lists = parts.filter("ends IS NOT NULL").select("a", "b", "depth", "shard", "ends").unionByName(
        silent.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("depth"), "shard", "ends"))
    out = found.drop("own_leaf", "own_saves").unionByName(top).join(_digests(lists), ["a", "b", "depth"], "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(df: DataFrame, group: int | None = None, heads: int = 3, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The trie of ``df`` (conv_id, turn, role, text), rebuilt first where ``group`` is given."""
    own = written(turns(df), "turns")
    convs = conversations(own)
    rows, convs = rebuilt(own, convs, group, heads) if group else (own, convs)
    return trie(rows, convs, shard, band)
