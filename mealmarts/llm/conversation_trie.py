"""Conversation prefix trie with subtree totals by depth bands.

``rebuild`` gives every conversation the first turns of the one it branched from. A prefix is named by its
depth and 128 bits: two exclusive-or sums over hashes of (depth, turn), so a prefix's name follows from the
one before it and a scan over a conversation runs in blocks of ``BLOCK`` turns, whatever its length. Grouping
by name gives the nodes; a node's owner is its smallest member, whose own prefixes are the node's ancestors.

``rollup`` adds up leaves and tokens over subtrees. Depths are cut into bands of ``BAND``. A node goes only to
its ancestors inside its band, at most ``BAND`` rows. Nodes at the top of a band stand for all below them
inside the band; as a tree of their own, ``BAND`` times less deep, they are rolled up by the same step, and
their finished totals then count as one more child of the node they hang on. So a tree of depth n takes
log(n) rounds to the base ``BAND``, each with that bound of rows per node.

Turns without conv_id belong to no conversation. Null role or text is empty. Turns of one number (null
included, which comes first) come in the order of a digest of role and text, so repeated rows are turns of
their own. A conversation that none of the table's turns start is absent. An empty table has no node, not
even a root. Other columns are ignored. A remainder has the sign of the conversation's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mealmarts.operators.ranking import number_rows
from mealmarts.session import stage

BAND, BLOCK = 16, 4096
BRANCH, SHARED = 100, 6  # conversations per base, and the bound of the number of turns they take from it
PIECE = 1 << 20  # characters of ids joined before they are hashed
_NODE = ["depth", "k1", "k2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, length): the turns in order, without their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.char_length(text).cast("long").alias("length"),
    ).filter("conv_id is not null")
    placed = number_rows(rows, [F.col("turn").asc_nulls_first(), F.col("digest")], "place", ["conv_id"])
    return placed.select("conv_id", F.col("place").cast("long").alias("place"), "digest", "length")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences (conv_id, depth, digest, length) and their members (conv_id, n_turns).

    A conversation takes crc32 of its id modulo ``SHARED`` turns from the first of its hundred, then goes on with
    its own. Heads have fewer than ``SHARED`` turns, and a base has at most ``BRANCH`` conversations.
    """
    turns = stage(turns, "turns")
    first = F.when(F.col("place") < SHARED, F.struct("place", "digest", "length"))
    own = stage(turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(first)).alias("head")), "heads")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    bases = own.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    none = F.array().cast(own.schema["head"].dataType)
    heads = (
        own.select("conv_id", "n", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % BRANCH).alias("base"))
        .join(bases, "base", "left")
        .select("conv_id", "n", "h", F.slice(F.coalesce("base_head", none), F.lit(1), F.col("h")).alias("head"))
    )
    members = stage(
        heads.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")),
        "members",
    )
    rest = turns.join(members.select("conv_id", "h", F.size("head").alias("shared")), "conv_id").filter("place > h")
    taken_turns = members.select("conv_id", F.explode("head").alias("t"))
    sequences = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("shared")).alias("depth"), "digest", "length").unionByName(
        taken_turns.select("conv_id", F.col("t.place").alias("depth"), F.col("t.digest"), F.col("t.length"))
    )
    return sequences, members.select("conv_id", "n_turns")


def _div(column: str, by: int) -> Column:
    return F.floor(F.col(column) / F.lit(by)).cast("long")


def prefixes(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, length, is_end): every prefix of every member with its name and its parent's.

    Names are running exclusive-ors, first inside blocks of ``BLOCK`` turns, then over the blocks of a conversation.
    """
    hashed = stage(
        sequences.withColumns({"z1": F.xxhash64("depth", "digest"), "z2": F.xxhash64("digest", "depth"), "block": _div("depth", BLOCK)}),
        "turn-hashes",
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("s1"), F.bit_xor("z2").alias("s2"))
    # Only conversations of over BLOCK turns have rows here.
    offsets = stage(
        sums.select("conv_id", "block", F.bit_xor("s1").over(before).alias("o1"), F.bit_xor("s2").over(before).alias("o2")).filter("block > 0"),
        "block-offsets",
    )

    def name(z: str, offset: str) -> Column:
        return F.bit_xor(z).over(inside).bitwiseXOR(F.coalesce(F.col(offset), F.lit(0)))

    named = (
        hashed.join(offsets, ["conv_id", "block"], "left")
        .withColumns({"k1": name("z1", "o1"), "k2": name("z2", "o2")})
        .join(members, "conv_id")
        .select(
            "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"),
            "length", (F.col("depth") == F.col("n_turns")).alias("is_end"),
        )
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = members.select(
        "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("length"),
        (F.col("n_turns") == 0).alias("is_end"),
    )
    return stage(named.unionByName(roots), "prefixes")


def nodes(paths: DataFrame) -> DataFrame:
    """(depth, k1, k2, conv_id, n_convs, n_ends, p1, p2, length): one row per distinct prefix."""
    return paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("is_end").cast("long")).alias("n_ends"),
        *[F.min(c).alias(c) for c in ("p1", "p2", "length")],
    )


def rollup(weights: DataFrame, paths: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """(depth, k1, k2, conv_id, leaves, saved): sums over the subtree of every node.

    ``weights``: (conv_id, depth, leaves, saved), one row per node, named by its owner. ``paths``: (conv_id, depth, k1, k2).
    """
    sums = [F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    paths = paths.select("conv_id", *_NODE)
    if deepest >= band:
        tops = paths.filter(F.col("depth") % band == 0).withColumn("depth", _div("depth", band))
        below = weights.withColumn("depth", _div("depth", band)).join(tops, ["conv_id", "depth"]).groupBy(*_NODE).agg(*sums)
        below = stage(below.select("conv_id", "depth", "leaves", "saved"), "band-tops")
        whole = rollup(below, tops, deepest // band, band).filter("depth > 0")
        # A finished top counts where it hangs: one depth above, on its owner's path.
        weights = weights.unionByName(whole.select("conv_id", (F.col("depth") * band - 1).alias("depth"), "leaves", "saved"))
    above = paths.withColumn("band", _div("depth", band))
    spread = weights.select("conv_id", _div("depth", band).alias("band"), F.col("depth").alias("_from"), "leaves", "saved")
    reached = spread.join(above, ["conv_id", "band"]).filter("depth <= _from")
    return stage(reached.groupBy(*_NODE).agg(*sums), "subtree-sums")


def end_digests(ends: DataFrame, limit: int = PIECE) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of (depth, k1, k2, conv_id): SHA-256 of a node's ids, ascending, comma-joined.

    Ids are range-sorted, so the ids of one node spread over tasks, and joined there into pieces of ``limit`` characters;
    a node's pieces are hashed in order, one at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size, out = None, [], 0, []
        for batch in batches:
            for *key, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or size >= limit:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids, size = key, [], 0
                ids.append(conv_id)
                size += 20
            yield from _rows(out, piece)
            out = []
        if ids:
            yield from _rows([(*node, ids[0], ",".join(map(str, ids)))], piece)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for *key, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(b"," + text.encode())
                else:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(text.encode())
            yield from _rows(out, digest)
            out = []
        if node:
            yield from _rows([(*node, sha.hexdigest())], digest)

    place = "depth long, k1 long, k2 long"
    names = [pa.field(c, pa.int64()) for c in _NODE]
    piece = pa.schema([*names, pa.field("first", pa.int64()), pa.field("ids", pa.string())])
    digest = pa.schema([*names, pa.field("ends_sha256", pa.string())])
    order = [*_NODE, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, f"{place}, first long, ids string")
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(hashed, f"{place}, ends_sha256 string")


def _rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def trie(sequences: DataFrame, members: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = prefixes(sequences, members)
    found = stage(nodes(paths), "nodes")
    deepest = found.agg(F.max("depth")).first()[0] or 0
    weights = found.select(
        "conv_id", "depth",
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("length")).alias("saved"),
    )
    sums = rollup(weights, paths, deepest, band).drop("conv_id")
    children = (
        found.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count("*").alias("n_children"))
    )
    ends = end_digests(paths.filter("is_end"))
    known = found.drop("n_ends", "length")
    # One grouping by the node brings the parts together.
    parts = known
    for part in (children, sums, ends):
        parts = parts.unionByName(part, allowMissingColumns=True)
    columns = ["conv_id", "n_convs", "p1", "p2", "n_children", "leaves", "saved", "ends_sha256"]
    whole = parts.groupBy(*_NODE).agg(*[F.max(c).alias(c) for c in columns])
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return whole.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
