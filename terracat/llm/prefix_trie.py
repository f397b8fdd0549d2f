"""Conversation prefix trie with a balanced rollup by centroid decomposition.

Every distinct sequence of first d turns (role, text) of a conversation is a
node.  A prefix is identified by two 64-bit sums (XOR) of hashes of (position,
role, text); sums are associative, so a conversation of any length is summed in
chunks, never in one task.  The smallest conversation of a node, its *owner*,
and the depth name the node: a conversation that starts with a node passes
through all of the node's ancestors, so the table of *paths* (conversation,
depth, owner) answers "which ancestor of v has depth d" by one equality join.

The rollup adds values over subtrees of the forest of parent edges below the
root.  Each round picks the centroid of every component (the deepest node whose
part of the component holds at least half of it), splits the component into the
parts below the centroid's children and the rest above, aggregates the totals
of what lies at and below the centroid, and adds them to the nodes on the way
from the centroid to the component's top, which are just the nodes that hold at
least half of the component.  Components halve, so a chain of n turns takes
log2(n) rounds; each round is written to the shared folder.

Defined results: rows without a conv_id belong to no conversation and are
ignored; a null role or text is empty; a null turn comes first; turns of equal
number follow by role, then the first 64 code points of the text, then a hash of
the whole; equal rows are turns each.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import dense_id
from ..sources.tables import materialize
from .mixing import WORD

#: Conversations that share a base, most turns taken from it (exclusive).
FAMILY, HEAD = 20, 4
#: Turns of a conversation summed together; range of ids joined into one text.
CHUNK, ID_RANGE = 1 << 12, 1 << 12

_NODE = ["owner", "depth"]


def _head(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("int")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, words): turns of every conversation from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.substring(text, 1, 64).alias("start"),
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), text, role).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("start"), F.col("h1"), F.col("h2")]
    ids = dense_id(rows, order, "id").select("conv", "id", "h1", "h2", "words")
    first = ids.groupBy("conv").agg(F.min("id").alias("first"))
    return ids.join(first, "conv").select("conv", (F.col("id") - F.col("first") + 1).alias("pos"), "h1", "h2", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of their family's first one:
    (conv, length) of all, and (conv, length, depth, h1, h2, words) of their turns."""
    turn = F.struct("pos", "h1", "h2", "words")
    convs = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = turns.where(F.col("pos") < HEAD).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("heads"))
    convs = (convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(heads, "base", "left")
             .withColumn("head", F.slice(F.coalesce("heads", F.expr("array()").cast(heads.schema["heads"].dataType)), F.lit(1), _head(F.col("conv")))))
    length = F.size("head") + F.greatest(F.col("own") - _head(F.col("conv")), F.lit(0))
    convs = materialize(convs.select("conv", "head", length.cast("long").alias("length")), "trie_conversations")
    given = convs.select("conv", "length", F.posexplode("head").alias("at", "turn")).select(
        "conv", "length", (F.col("at") + 1).cast("long").alias("depth"), "turn.h1", "turn.h2", "turn.words")
    own = turns.where(F.col("pos") > _head(F.col("conv"))).join(convs.select("conv", "length", F.size("head").alias("given")), "conv").select(
        "conv", "length", (F.col("pos") - _head(F.col("conv")) + F.col("given")).cast("long").alias("depth"), "h1", "h2", "words")
    return convs.select("conv", "length"), given.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, length, depth, k1, k2, words): the prefix that ends at each turn."""
    own = turns.withColumn("k1", F.xxhash64("depth", "h1", "h2")).withColumn("k2", F.xxhash64("h2", "depth", "h1"))
    own = own.withColumn("chunk", F.floor(F.col("depth") / CHUNK))
    inside = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = own.select("conv", "length", "chunk", "depth", "words", *[F.bit_xor(k).over(inside).alias(k) for k in ("k1", "k2")])
    # one row per CHUNK turns of the conversations that have several chunks
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.where(F.col("length") >= CHUNK).groupBy("conv", "chunk").agg(F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
    sums = sums.select("conv", "chunk", *[F.coalesce(F.bit_xor(k).over(before), F.lit(0)).alias(f"{k}_before") for k in ("k1", "k2")])
    whole = [F.col(k).bitwiseXOR(F.coalesce(f"{k}_before", F.lit(0))).alias(k) for k in ("k1", "k2")]
    return local.join(sums, ["conv", "chunk"], "left").select("conv", "length", "depth", *whole, "words")


def centroid_rollup(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over the subtree of every node.

    ``nodes``: owner, depth, top_owner, top_depth (the top of its tree), size
    (nodes in its subtree) and the values (longs).  ``paths``: conv, depth,
    owner, parent for every owner's way down: the node at that depth and the
    owner of the node above."""
    comp = ["top_owner", "top_depth"]
    kept = [*_NODE, *values]
    live = materialize(nodes.select(*_NODE, *comp, "size", *values, *[F.lit(0).cast("long").alias(f"{v}_sum") for v in values]), "trie_round")
    done: list[DataFrame] = []
    final = lambda plus: [(F.col(f"{v}_sum") + plus(v)).alias(v) for v in values]
    while True:
        whole = live.groupBy(*comp).agg(F.max("size").alias("whole"))
        # written, so that nothing after the join needs a component's rows together and Spark can split a large one
        sized = materialize(live.join(whole, comp), "trie_sized")
        done.append(sized.where(F.col("whole") == 1).select(*_NODE, *final(F.col)))
        large = sized.where(F.col("whole") > 1)
        half = F.col("size") * 2 >= F.col("whole")
        centroid = large.where(half).groupBy(*comp).agg(F.min(F.struct("size", *_NODE)).alias("c"))
        marked = large.join(centroid, comp).withColumn("heavy", half)
        # a deeper node may lie below the centroid: ask for its ancestor just under it
        ask = F.when(F.col("depth") > F.col("c.depth"), F.col("c.depth") + 1)
        way = paths.select(F.col("conv").alias("owner"), F.col("depth").alias("ask"), F.col("owner").alias("child"), F.col("parent").alias("above"))
        marked = marked.withColumn("ask", ask).join(way, ["owner", "ask"], "left")
        below = F.coalesce(F.col("above") == F.col("c.owner"), F.lit(False))
        itself = (F.col("owner") == F.col("c.owner")) & (F.col("depth") == F.col("c.depth"))
        marked = materialize(marked.withColumn("below", below).withColumn("itself", itself), "trie_marked")
        totals = marked.where("below or itself").groupBy(*comp).agg(*[F.sum(v).alias(f"{v}_total") for v in values])
        added = marked.join(totals, comp)
        done.append(materialize(added.where("itself").select(*_NODE, *final(lambda v: F.col(f"{v}_total"))), "trie_done"))
        above = F.col("heavy") & ~F.col("itself")
        live = materialize(added.where("not itself").select(
            *kept, F.when(F.col("below"), F.col("child")).otherwise(F.col("top_owner")).alias("top_owner"),
            F.when(F.col("below"), F.col("ask")).otherwise(F.col("top_depth")).alias("top_depth"),
            F.when(above, F.col("size") - F.col("c.size")).otherwise(F.col("size")).alias("size"),
            *[(F.col(f"{v}_sum") + F.when(above, F.col(f"{v}_total")).otherwise(0)).alias(f"{v}_sum") for v in values]), "trie_round")
        if not live.limit(1).count():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node: its texts arrive in order and are only streamed."""
    node, digest = None, None
    for batch in batches:
        out = []
        for owner, depth, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (owner, depth) == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (owner, depth), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["owner", "depth", "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], ["owner", "depth", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the joined ids (ascending) per node.  ``ends``: owner, depth,
    conv.  Ids are joined per range of ``ID_RANGE``; the digest, sequential by
    its nature, reads a node's ranges as a stream."""
    ranges = ends.groupBy(*_NODE, F.floor(F.col("conv") / ID_RANGE).alias("range")).agg(
        F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    return (ranges.repartition(*_NODE).sortWithinPartitions(*_NODE, "range").select(*_NODE, "ids")
            .mapInArrow(_hashed, "owner long, depth long, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = materialize(numbered_turns(conversations), "trie_turns")
    convs, rows = rebuilt(turns)
    rows = materialize(prefixes(rows), "trie_prefixes")
    key = ["depth", "k1", "k2"]
    nodes = materialize(rows.groupBy(*key).agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
                                               F.max("words").alias("words")), "trie_nodes")
    placed = materialize(rows.join(nodes.select(*key, "owner"), key).select("conv", "length", "depth", "owner"), "trie_placed")
    # owners' ways down; an owner's own nodes are the lower part of its way, from depth "own" on
    owners = placed.where(F.col("owner") == F.col("conv")).groupBy("conv").agg(F.min("depth").alias("own"))
    paths = placed.join(owners, "conv")
    over = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    paths = materialize(paths.join(over, ["conv", "depth"], "left"), "trie_paths")
    size = paths.groupBy(*_NODE).agg(F.sum(F.col("length") - F.greatest("depth", "own") + 1).alias("size"))
    tops = paths.where(F.col("depth") == 1).select("conv", F.col("owner").alias("top_owner"))
    edges = (paths.where(F.col("owner") == F.col("conv")).select("conv", *_NODE, "parent").join(tops, "conv").drop("conv")
             .join(size, _NODE).join(nodes.select(*_NODE, "n_convs", "words"), _NODE))
    children = edges.where(F.col("depth") > 1).groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("words")
    nodes = materialize(edges.join(children, _NODE, "left").select(
        *_NODE, "parent", "top_owner", F.lit(1).cast("long").alias("top_depth"), "size", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"), saved.alias("saved_tokens")), "trie_forest")
    summed = centroid_rollup(nodes, paths, ["n_leaves", "saved_tokens"])

    first = convs.agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("n_convs")).first()
    if first["first"] is None:
        first = {"first": 0, "n_convs": 0}
    ends = placed.where(F.col("depth") == F.col("length")).select(*_NODE, "conv").unionByName(
        convs.where(F.col("length") == 0).select(F.lit(first["first"]).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv"))
    root = nodes.agg(F.sum((F.col("depth") == 1).cast("long")).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                     F.sum("saved_tokens").alias("saved_tokens"))
    root = root.select(F.lit(first["first"]).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"),
                       F.lit(None).cast("long").alias("parent"), F.lit(first["n_convs"]).cast("long").alias("n_convs"),
                       F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
                       F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens")).where(F.col("n_convs") > 0)
    root_owner = F.when(F.col("depth") == 1, F.lit(first["first"])).otherwise(F.col("parent")).cast("long").alias("parent")
    every = nodes.select(*_NODE, root_owner, "n_convs", "n_children").join(summed, _NODE).unionByName(root)
    none = hashlib.sha256(b"").hexdigest()
    return every.join(ends_digest(ends), _NODE, "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
