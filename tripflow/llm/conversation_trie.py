"""Operator 11, the prefix trie of conversations with subtree totals by depth-band rollup.

A node is a distinct sequence of first turns (role, text) that some conversation starts with; the
conversations that start with it are its members. The root is the empty sequence.

Keys: a turn has a digest of role and text; the key of a prefix is the xor of 120 bits of hash of
(depth, digest) over its turns, a running xor in each conversation. Runs of ``_RUN`` turns are one
window each and the totals of earlier runs are added, so a conversation of any length is many
tasks. A prefix that all conversations share is one group of counts, pre-aggregated where it is read.

Totals over subtrees: depths are cut into bands of ``band``. A node sends its own amounts to its
ancestors within the band above it, down from the band's top (at most ``band`` of them), all bands at
once. Then the tops of the deepest band have all that lies below them and send that on to their
ancestors in the next band up, and so on: the number of rounds is that of the bands, and no node is
copied more than ``band`` times in each. Only nodes with two members or more take part: below a node
with one member there is one chain with one leaf and nothing saved, so its parent counts it at once.

Members that end at a node are hashed in order without being gathered: rows are sorted by (node, id)
over range partitions, joined to pieces of bounded length there, and the pieces of a node are fed to one
digest as they come.

Turns are ordered by turn (null first), ties by role and text; null role and text are empty. Rows that repeat in all
columns are turns of their own. Rows without a conv_id belong to no conversation and are left out. Texts of any length
are hashed whole; a very long conversation is a chain like any other. An empty table has no members, hence
no nodes. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.blocks import rows
from tripflow.llm.common import WORD, materialize, rank_rows, ship

_RUN = 4096
_PIECE = 1 << 16
NODE = ["depth", "k1", "k2"]


def _h(conv_id: Column, heads: int) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % heads


def ordered_turns(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored tables (conv_id, pos from 1, digest, words) of the turns in their order, and (conv_id, n) of the conversations."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = materialize(spark, rank_rows(spark, narrow, order, "trie-order", drop=("turn", "role", "text")), "trie-turns")
    convs = materialize(spark, placed.groupBy("conv_id").agg(F.min("row_no").alias("first_row"), F.count(F.lit(1)).alias("n")), "trie-conversations")
    located = placed.join(convs.select("conv_id", "first_row"), "conv_id").select(
        "conv_id", (F.col("row_no") - F.col("first_row") + 1).alias("pos"), "digest", "words")
    return located, convs.select("conv_id", "n")


def rebuilt(spark: SparkSession, turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations with the beginning of another: (conv_id, depth, digest, words) of their turns and (conv_id, n).

    Conversation c takes the first h = crc32(c) % ``heads`` turns of conversation c - c % ``group`` in place of its own first h.
    """
    own, convs = ordered_turns(spark, turns)
    own = materialize(spark, own, "trie-own-turns")
    convs = convs.select("conv_id", "n", _h(F.col("conv_id"), heads).alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = materialize(spark, convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "trie-plan")
    kept = own.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "digest", "words")
    first = own.where((F.col("pos") < heads) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    lent = first.join(convs.select("conv_id", "base", "taken"), "base").where("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "digest", "words")
    sizes = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return kept.unionByName(lent), sizes


def prefix_keys(turns: DataFrame) -> DataFrame:
    """Add k1, k2 (the key of the prefix that ends with the turn) and p1, p2 (that of the prefix before it)."""
    both = F.sha2(F.concat_ws(":", "depth", "digest"), 256)
    lanes = turns.select("conv_id", "depth", "words", F.expr(f"depth div {_RUN}").alias("run"),
                         *[F.conv(F.substring(both, at, 15), 16, 10).cast("long").alias(x) for x, at in (("x1", 1), ("x2", 16))])
    within = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each run of a conversation that has several.
    totals = lanes.groupBy("conv_id", "run").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    several = lanes.where("run > 0").select("conv_id").distinct()
    before = (totals.join(several, "conv_id", "left_semi")
              .select("conv_id", "run", F.bit_xor("t1").over(earlier).alias("b1"), F.bit_xor("t2").over(earlier).alias("b2")))
    summed = lanes.withColumn("s1", F.bit_xor("x1").over(within)).withColumn("s2", F.bit_xor("x2").over(within))
    keyed = summed.join(before, ["conv_id", "run"], "left")
    for lane in "12":
        keyed = keyed.withColumn(f"k{lane}", F.col(f"s{lane}").bitwiseXOR(F.coalesce(f"b{lane}", F.lit(0).cast("long"))))
    return keyed.select("conv_id", "depth", "words", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids, ascending, of the rows (depth, k1, k2, conv_id) of each node."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece():
            return pa.RecordBatch.from_pydict({"depth": [node[0]], "k1": [node[1]], "k2": [node[2]], "first": [first], "ids": [",".join(held)]})

        node, first, held, size = None, None, [], 0
        for *key, c in rows(batches):
            if held and (key != node or size >= _PIECE):
                yield piece()
                held, size = [], 0
            if not held:
                node, first = key, c
            held.append(str(c))
            size += len(held[-1]) + 1
        if held:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            return pa.RecordBatch.from_pydict({"depth": [node[0]], "k1": [node[1]], "k2": [node[2]], "digest": [state.hexdigest()]})

        node, state = None, None
        for *key, _, ids in rows(batches):
            if key != node:
                if state is not None:
                    yield done()
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if state is not None:
            yield done()

    pieces = (ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
              .mapInArrow(join, "depth long, k1 long, k2 long, first long, ids string"))
    return (pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, k1 long, k2 long, digest string"))


def trie(spark: SparkSession, turns: DataFrame, sizes: DataFrame, band: int = 32) -> DataFrame:
    """The nodes of the trie of conversations given by their turns (conv_id, depth from 1 without gaps, digest, words) and ``sizes``
    (conv_id, n: number of turns, 0 allowed): conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens (of the subtree; a node saves its last turn's words for all members but one), and ends_sha256."""
    if band < 1:
        raise ValueError("a band has at least one depth")
    ship(spark)
    sizes = materialize(spark, sizes, "trie-sizes")
    zero = F.lit(0).cast("long")
    roots = sizes.select("conv_id", zero.alias("depth"), zero.alias("words"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), (F.col("n") == 0).alias("ends"))
    inner = prefix_keys(turns).join(sizes, "conv_id").withColumn("ends", F.col("depth") == F.col("n")).drop("n")
    paths = materialize(spark, inner.unionByName(roots), "trie-paths")
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("end_id"))
    nodes = materialize(spark, nodes, "trie-nodes")

    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = (nodes.where("depth > 0").select(*parent, F.col("n_convs")).groupBy(*NODE)
                .agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("chains")))
    shared = nodes.where("n_convs > 1").join(children, NODE, "left").na.fill(0, ["n_children", "chains"])
    shared = materialize(spark, shared.select(
        *NODE, "conv_id", "n_children", (F.col("chains") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-shared")

    # Ancestors of each shared node in a band, along its smallest member: at most ``band`` keys a row.
    along = (paths.join(shared.select("conv_id").distinct(), "conv_id", "left_semi")
             .groupBy("conv_id", F.expr(f"depth div {band}").alias("in_band")).agg(F.collect_list(F.struct(*NODE)).alias("keys")))
    along = materialize(spark, along, "trie-bands")

    def sent(amounts: DataFrame) -> DataFrame:
        """What ancestors in the band above get of rows (conv_id, depth, leaves, saved)."""
        up = amounts.where("depth > 0").withColumn("in_band", F.expr(f"(depth - 1) div {band}")).withColumnRenamed("depth", "at")
        return (up.join(along, ["conv_id", "in_band"]).select("at", "leaves", "saved", F.explode("keys").alias("to")).where("to.depth < at")
                .groupBy(*[F.col(f"to.{c}").alias(c) for c in NODE]).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))

    got = [materialize(spark, sent(shared.select("conv_id", "depth", "leaves", "saved")), "trie-received")]
    deepest = shared.agg(F.max("depth").alias("d")).first()["d"] or 0
    for top in range(deepest // band * band, 0, -band):
        below = got[0].where(F.col("depth") == top)
        if len(got) > 1:
            below = below.unionByName(got[-1].where(F.col("depth") == top))
        below = below.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        got.append(materialize(spark, sent(shared.select(*NODE, "conv_id").join(below, NODE)), "trie-received"))
    received = got[0]
    for more in got[1:]:
        received = received.unionByName(more)
    received = received.groupBy(*NODE).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    totals = shared.join(received, NODE, "left").select(
        *NODE, F.col("n_children").alias("c"), (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"))

    digests = _end_digests(paths.where("ends").join(nodes.where("n_ends > 1").select(*NODE), NODE, "left_semi"))
    above = shared.select(F.col("depth").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), F.col("conv_id").alias("above"))
    few = F.sha2(F.coalesce(F.col("end_id").cast("string"), F.lit("")), 256)
    return (nodes.join(totals, NODE, "left").join(digests, NODE, "left")
            .join(above, (F.col("depth") - 1 == F.col("_d")) & (F.col("p1") == F.col("_1")) & (F.col("p2") == F.col("_2")), "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
                    F.coalesce("c", 1 - F.col("n_ends")).alias("n_children"), F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
                    F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("digest", few).alias("ends_sha256")))
