"""The trie of conversation prefixes, by hashing blocks of turns.

Every conversation is rebuilt first: it begins with the first h turns of the conversation
whose id is a multiple of 100 (``base``), and goes on with its own turns after its first h;
h is the CRC-32 of its decimal id modulo 6. A node is a distinct sequence of first turns.

A prefix has a digest: the sums of four 32-bit lanes of a hash of place and turn, so all
digests come from running sums, cut into spans for long conversations. Conversations are
grouped by the digests at the ends of blocks of BLOCK turns. Where all that go on from one
block share the next, its turns are nodes with the members of the block. Only blocks
whose siblings differ are taken apart, and their turns grouped again.

Sums over a subtree need no walk through it. The smallest member owns a node, and owns
then all of its own path below. So the nodes of a subtree are the owned turns of its
members, and leaves and turn lengths of a subtree are sums over members, for any depth.

Turns are in the order of their number, null first, equal ones in the order of the SHA-256
of role and text; a turn that is repeated counts each time. Places come from ranges of
(conversation, turn, digest), so a conversation may lie in many tasks. A null role or text
is empty. Rows with a null conversation id take no part. An empty table has no node. Only
the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Work
from tidemark.session import local_frame, materialise

BLOCK = 4
# Turns of a conversation whose running sums are taken in one task; a multiple of BLOCK.
SPAN = 1 << 16
# The most turns that a conversation takes from its base.
HEAD = 5
# Ids of one piece of the text that is hashed for the ends of a node, as a power of two.
IDS = 12

LANES = ("a", "b", "c", "d")


def _base(conv: Column) -> Column:
    return conv - conv % 100


def _taken(conv: Column) -> Column:
    """How many turns come from the base."""
    return (F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def _key(lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", *lanes)))


def _no_turns() -> Column:
    return _key([F.lit(0)] * len(LANES))


def numbered(rows: DataFrame) -> DataFrame:
    """(conv, digest, size, part, local): place of each turn among those of its part."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv").to_numpy()
            start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            length = np.diff(np.r_[start, n])
            local = np.arange(1, n + 1) - np.repeat(start, length)
            if conv[0] == last:
                local[: length[0]] += count
            last, count = conv[-1], local[-1]
            arrays = [batch.column(c) for c in ("conv", "digest", "size")]
            arrays += [pa.array(np.full(n, part, np.int32)), pa.array(local.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv", "digest", "size", "part", "local"])

    dealt = rows.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest")
    return dealt.mapInArrow(number, "conv long, digest binary, size long, part int, local long")


def placed(turns: DataFrame) -> DataFrame:
    """(conv, pos, digest, size): parts are put together by what earlier parts hold of a conversation."""
    edges = turns.groupBy("part").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by("local", F.struct("conv", "local")).alias("n")
    )
    before, running, previous = [], 0, None
    # One row per part.
    for r in edges.orderBy("part").collect():
        running = running if r["first"] == previous else 0
        if running:
            before.append((r["part"], r["first"], running))
        running = r["n"] + (running if r["last"] == r["first"] else 0)
        previous = r["last"]
    if not before:
        return turns.select("conv", F.col("local").alias("pos"), "digest", "size")
    earlier = local_frame(turns.sparkSession, before, "part int, conv long, before long")
    joined = turns.join(F.broadcast(earlier), ["part", "conv"], "left")
    return joined.select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "size")


def rebuilt_from(turns: DataFrame) -> DataFrame:
    """(conv, taken, head, length, total): the turns each conversation takes, its turns and code points."""
    turn = F.struct("pos", "digest", "size")
    heads = turns.where((F.col("pos") <= HEAD) & (F.col("conv") % 100 == 0)).groupBy(F.col("conv").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = F.col("pos") > F.col("taken")
    convs = turns.withColumn("taken", _taken(F.col("conv"))).groupBy("conv", "taken")
    convs = convs.agg(F.count(F.when(own, 1)).alias("n"), F.coalesce(F.sum(F.when(own, F.col("size"))), F.lit(0)).alias("own"))
    joined = convs.withColumn("base", _base(F.col("conv"))).join(heads, "base", "left")
    head = F.slice(F.coalesce("turns", F.array().cast("array<struct<pos:long,digest:binary,size:long>>")), F.lit(1), F.col("taken"))
    joined = joined.select("conv", "taken", "n", "own", head.alias("head"))
    return joined.select(
        "conv", "taken", "head",
        (F.col("n") + F.size("head")).alias("length"),
        (F.col("own") + F.aggregate("head", F.lit(0).cast("long"), lambda s, t: s + t["size"])).alias("total"),
    )


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Each turn of the rebuilt conversations with running sums of lanes and sizes.

    (conv, length, total, pos, size, span, sum, lanes a to d, their own part as own_a to own_d).
    """
    own = turns.join(convs.select("conv", "taken", F.size("head").alias("n"), "length", "total"), "conv")
    own = own.where(F.col("pos") > F.col("taken"))
    own = own.select("conv", "length", "total", (F.col("pos") - F.col("taken") + F.col("n")).alias("pos"), "digest", "size")
    begun = convs.select("conv", "length", "total", F.explode("head").alias("t")).select("conv", "length", "total", "t.*")
    rows = own.unionByName(begun)
    words = [F.xxhash64(F.lit(i), "pos", "digest") for i in (1, 2)]
    parts = [half for x in words for half in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))]
    rows = rows.withColumns({f"own_{c}": x for c, x in zip(LANES, parts, strict=True)})
    rows = rows.drop("digest").withColumn("span", F.floor((F.col("pos") - 1) / SPAN))
    sums = {**{c: f"own_{c}" for c in LANES}, "sum": "size"}
    running = Window.partitionBy("conv", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({c: F.sum(own).over(running) for c, own in sums.items()})
    longest = convs.agg(F.max("length")).first()[0] or 0
    if longest <= SPAN:
        return summed
    spans = rows.where(F.col("length") > SPAN).groupBy("conv", "span").agg(*[F.sum(own).alias(c) for c, own in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "span", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums])
    joined = summed.join(spans, ["conv", "span"], "left")
    joined = joined.withColumns({c: F.col(c) + F.coalesce(f"before_{c}", F.lit(0)) for c in sums})
    return joined.drop(*[f"before_{c}" for c in sums])


def in_blocks(rows: DataFrame) -> DataFrame:
    """(conv, length, total, block, parent, turns, key): BLOCK turns at a time, with the digest of each prefix."""
    before = _key([F.col(c) - F.col(f"own_{c}") for c in LANES])
    keyed = rows.select(
        "conv", "span", "length", "total", F.floor((F.col("pos") - 1) / BLOCK).alias("block"), before.alias("parent"),
        F.struct("pos", _key([F.col(c) for c in LANES]).alias("key"), "size", "sum").alias("turn"),
    )
    blocks = keyed.groupBy("conv", "span", "block").agg(
        F.first("length").alias("length"), F.first("total").alias("total"),
        F.min_by("parent", F.col("turn.pos")).alias("parent"), F.sort_array(F.collect_list("turn")).alias("turns"),
    )
    return blocks.drop("span").withColumn("key", F.element_at("turns", -1)["key"])


def grouped(blocks: DataFrame) -> DataFrame:
    """The groups of equal blocks behind equal prefixes, and how many groups share the prefix (``siblings``)."""
    ended = F.element_at("turns", -1)["pos"] == F.col("length")
    groups = blocks.groupBy("block", "key").agg(
        F.count("*").alias("n"), F.count(F.when(ended, 1)).alias("ended"), F.min("conv").alias("owner"),
        F.sum("total").alias("total"), F.first("parent").alias("parent"), F.first("turns").alias("turns"),
    )
    siblings = groups.groupBy("block", "parent").agg(F.count("*").alias("siblings"))
    return groups.join(siblings, ["block", "parent"])


def refined(groups: DataFrame, merged: dict[str, Column]) -> DataFrame:
    """A row per node (depth, key, above, size, sum, ended and what ``merged`` names).

    Turns of a block without siblings are nodes as they are; those of siblings are grouped.
    """
    opened = groups.select("*", F.posexplode("turns").alias("i", "turn"))
    above = F.when(F.col("i") == 0, F.col("parent")).otherwise(F.get("turns", F.col("i") - 1)["key"])
    ended = F.when(F.col("i") == F.size("turns") - 1, F.col("ended")).otherwise(0)
    nodes = opened.select(
        "siblings", F.col("turn.pos").alias("depth"), F.col("turn.key").alias("key"), above.alias("above"),
        F.col("turn.size").alias("size"), F.col("turn.sum").alias("sum"), ended.alias("ended"), *merged,
    )
    alone = nodes.where("siblings = 1").drop("siblings")
    shared = nodes.where("siblings > 1").groupBy("depth", "key").agg(
        *[F.first(c).alias(c) for c in ("above", "size", "sum")], F.sum("ended").alias("ended"),
        *[how.alias(c) for c, how in merged.items()],
    )
    return alone.unionByName(shared)


def ends_of(ends: DataFrame) -> DataFrame:
    """(depth, key, ends): SHA-256 of the ids that end at a node, in order; ids are joined in pieces."""
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = ends.groupBy("depth", "key", F.shiftright("conv", IDS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    dealt = pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "ids")), strict=True):
                if (depth, key) == current:
                    state.update(b",")
                else:
                    if state:
                        out.append((*current, state.hexdigest()))
                    current, state = (depth, key), hashlib.sha256()
                state.update(ids.encode())
            yield _digests(out)
        if state:
            yield _digests([(*current, state.hexdigest())])

    return dealt.mapInArrow(digest, "depth long, key binary, ends string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.string())
    arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(arrays, names=["depth", "key", "ends"])


def prefix_trie(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    own_role, own_text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    written = F.concat(F.char_length(own_role).cast("string"), F.lit(":"), own_role, own_text)
    rows = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(written, 256), 1, 32)).alias("digest"), F.char_length(own_text).cast("long").alias("size"),
    )
    with Work(df.sparkSession) as work:
        turns = placed(work.table(numbered(rows), "turns"))
        convs = work.table(rebuilt_from(turns), "convs")
        blocks = work.table(in_blocks(prefixes(turns, convs)), "blocks")
        groups = work.table(grouped(blocks), "groups")

        # What each conversation owns: the code points of its nodes, and whether a leaf is among them.
        first = refined(groups, {"n": F.sum("n"), "owner": F.min("owner")})
        owned = first.groupBy(F.col("owner").alias("conv")).agg(
            F.sum("size").alias("owned"), F.max((F.col("ended") == F.col("n")).cast("long")).alias("leaf")
        )
        owned = work.table(owned, "owned")

        sums = blocks.select("conv", "block", "key", "total").join(owned, "conv").groupBy("block", "key")
        sums = sums.agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("leaves"), F.min(F.struct("conv", "owned", "total")).alias("smallest"))
        known = groups.join(sums, ["block", "key"], "left")
        known = known.fillna(0, ["owned", "leaves"])
        merged = {
            "n": F.sum("n"), "total": F.sum("total"), "owned": F.sum("owned"),
            "leaves": F.sum("leaves"), "smallest": F.min("smallest"),
        }
        nodes = refined(known, merged)
        whole = convs.join(owned, "conv", "left").fillna(0, ["owned", "leaf"])
        root = whole.agg(
            F.count("*").alias("n"), F.sum("total").alias("total"), F.sum("owned").alias("owned"),
            F.greatest(F.sum("leaf"), F.lit(1)).alias("leaves"), F.min(F.struct("conv", "owned", "total")).alias("smallest"),
            F.count(F.when(F.col("length") == 0, 1)).alias("ended"),
        ).where("n > 0")
        root = root.withColumns({"depth": F.lit(0).cast("long"), "key": _no_turns(), "above": F.lit(None).cast("binary")})
        zero = F.lit(0).cast("long")
        nodes = work.table(nodes.unionByName(root.withColumns({"size": zero, "sum": zero})), "nodes")

        children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above").alias("key"))
        children = children.agg(F.count("*").alias("children"))
        ended = blocks.select("conv", F.element_at("turns", -1)["pos"].alias("depth"), "key", "length").where("depth = length")
        turnless = convs.where("length = 0").select("conv", F.lit(0).cast("long").alias("depth"), _no_turns().alias("key"))
        ends = ends_of(ended.drop("length").unionByName(turnless))
        parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("above"), F.col("smallest.conv").alias("parent"))

        full = nodes.join(children, ["depth", "key"], "left").join(ends, ["depth", "key"], "left")
        full = full.join(parents, ["depth", "above"], "left")
        before = F.col("sum") - F.col("size")
        all_turns = F.col("total") - F.col("n") * before
        distinct_turns = F.col("owned") - F.col("smallest.owned") + F.col("smallest.total") - before
        result = full.select(
            F.col("smallest.conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.coalesce("children", zero).alias("n_children"), F.col("leaves").alias("n_leaves"),
            (all_turns - distinct_turns).alias("saved_tokens"),
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
        return materialise(result, "trie")
