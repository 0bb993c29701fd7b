"""Operator 3, mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

1. Targets: sources share ``share`` times all words by weight; no target exceeds
   ``max_epochs`` times its source, and the excess is reshared by weight (water level).
2. Streams: the documents of a source stand in a shuffled order (by hash) and form one
   stream of words, cut into blocks of ``block`` words (only its last may be shorter).
3. Schedule: slot i of the mix has the point ``i * K mod 2**31`` (K is 2**31 over the
   golden ratio, odd), which falls into one source's part of the cumulative number of
   blocks. The slots of a source are ranked; rank r takes block ``r mod blocks`` in epoch
   ``r div blocks``. A source's schedule ends with its target: its last slot takes what is
   left, and the few ranks that the points leave out (their discrepancy is logarithmic)
   follow at the end. So each source gives its rounded target exactly.
4. Join: slots meet the blocks, hence the documents with words in them.

A hot source is never one task: streams are built by (source, hash bucket) and slots are
ranked by (source, chunk of slots), each with the sums of earlier buckets or chunks added.
Sides that grow with the words (slots, chunks) are joined by sort-merge and never broadcast;
the planner may broadcast the others (sources, cells of the schedule, parts of a ranking).

Null texts, empty texts and texts of white space have size 0, target words go to others,
and they are taken 0 times. A null source is a source, the last in order. Repeated rows
and repeated doc_ids are documents of their own; equal ones are interchangeable. An empty
table, or one without words, gives targets and takes of 0. Names of other columns do not
matter: only the named ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import SPACE, WORD, materialize, rank_rows

_PERIOD = 1 << 31
_GOLDEN = 1327217885  # 2**31 / golden ratio, odd: i -> i * _GOLDEN mod 2**31 meets every point once
_CHUNK_SLOTS = 4096


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The beginning of a text up to the end of its ``n``-th word, white space as it stands."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{SPACE[:-1]}*{WORD}"), F.lit(0)), F.lit(1), n.cast("int")), "")


def source_targets(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   max_epochs: int = 2) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source_size, weight, target and
    ``take`` (the target in whole words). Weights repeat along the sources in code point
    order, null last; every weight is positive."""
    scale = 1
    for w in weights:
        scale *= w
    by_source = materialize(spark, sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = rank_rows(spark, by_source, [F.col("source").asc_nulls_last()], "mix-source-order")
    weighted = (ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("row_no") % len(weights)).cast("int") + 1).cast("long"))
                .withColumn("cap", F.col("source_size") * max_epochs)
                .withColumn("fills_at", F.expr(f"cap * {scale} div weight"))  # order by cap / weight, exactly
                .drop("row_no"))
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("all_weight")).first()
    goal = share * total["all_size"]
    # Sources fill up in the order of cap / weight. The level is that at the first source that
    # stays below its cap; every later source would give a lower one, so it is a maximum.
    filled = rank_rows(spark, materialize(spark, weighted, "mix-weighted"), [F.col("fills_at").asc(), F.col("source").asc_nulls_last()], "mix-levels",
                       totals=("cap", "weight"))
    level = (F.lit(goal) - F.col("cap_before")) / (F.lit(total["all_weight"]) - F.col("weight_before"))
    below = level * F.col("weight") <= F.col("cap")
    water = filled.agg(F.max(F.when(below, level)).alias("level")).first()["level"]
    # No level: everything is full (share at or above max_epochs).
    target = F.col("cap").cast("double") if water is None else F.least(F.col("cap").cast("double"), F.lit(water) * F.col("weight"))
    return (filled.withColumn("target", target)
            .withColumn("take", F.least("cap", F.floor(F.col("target") + 0.5)))
            .select("source", "source_size", "weight", "target", "take"))


def source_streams(spark: SparkSession, sizes: DataFrame, seed: int = 3) -> DataFrame:
    """Add ``start``: the place of a document's first word in its source's shuffled stream.

    ``sizes`` is a stored table with doc_id, source, size and a unique ``uid``; the order is
    by the hash of doc_id, and for equal hashes by size. All streams are numbered as one, source after source, in
    ranges of rows that ``uid`` also splits: neither a large source nor a repeated (or null) doc_id is one task.
    """
    h = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    in_order = [F.col("source").asc_nulls_last(), F.col("order_hash"), F.col("size"), F.col("uid")]
    placed = rank_rows(spark, sizes.withColumn("order_hash", h), in_order, "mix-streams", totals=("size",), drop=("order_hash",))
    by_source = materialize(spark, sizes.groupBy("source").agg(F.sum("size").alias("whole")), "mix-stream-sizes")
    first = rank_rows(spark, by_source, [F.col("source").asc_nulls_last()], "mix-stream-order", totals=("whole",))
    first = first.select(F.col("source").alias("_s"), "whole_before")
    return (placed.join(first, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("start", F.col("size_before") - F.col("whole_before"))
            .drop("_s", "whole_before", "size_before", "row_no"))


def schedule(spark: SparkSession, targets: DataFrame, block: int = 1024, cells_least: int = 4096) -> DataFrame:
    """The slots of the mix: slot (order of the mix), source, rank, epoch, block_no and
    ``tokens`` (words the slot takes of its block). ``targets`` as of :func:`source_targets`."""
    plan = (targets.where("source_size > 0 AND take > 0")
            .withColumn("blocks", F.expr(f"(source_size + {block} - 1) div {block}"))
            .withColumn("need", F.expr(f"(take div source_size) * blocks + ((take % source_size) + {block} - 1) div {block}")))
    plan = rank_rows(spark, materialize(spark, plan, "mix-plan"), [F.col("source").asc_nulls_last()], "mix-plan-order", totals=("need",))
    plan = materialize(spark, plan, "mix-parts")
    size = plan.agg(F.coalesce(F.sum("need"), F.lit(0)).alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    slots, cells = size["slots"], max(cells_least, 4 * size["sources"])
    width = max(1, -(-slots // cells))

    # Which source holds a point: parts and points meet by equal-width cells, not by a range condition alone.
    parts = plan.select("source", "need", "need_before", F.explode(F.sequence(
        F.expr(f"need_before div {width}"), F.expr(f"(need_before + need - 1) div {width}"))).alias("cell"))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("point", F.floor(((F.col("slot") % _PERIOD) * _GOLDEN % _PERIOD) / F.lit(float(_PERIOD)) * F.lit(float(slots))))
              .withColumn("cell", F.expr(f"point div {width}")))
    placed = (points.join(parts, "cell").where("point >= need_before AND point < need_before + need")
              .select("slot", "source", "need_before", "need", F.expr(f"slot div {_CHUNK_SLOTS}").alias("chunk")))

    # Rank within the source: within a chunk of slots, plus the slots of earlier chunks. need_before names a source uniquely.
    # Source and chunk in one key: as two, Spark may deal rows by the source alone, and a hot one is one task.
    per_chunk = placed.groupBy("need_before", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("need_before").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    part = F.concat_ws("/", "need_before", "chunk").alias("part")
    offsets = per_chunk.withColumn("ranks_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(part, "ranks_before")
    ranked = (placed.select("*", part)
              .withColumn("in_chunk", F.row_number().over(Window.partitionBy("part").orderBy("slot")) - 1)
              .join(offsets.hint("merge"), "part")
              .withColumn("rank", F.col("ranks_before") + F.col("in_chunk"))
              .where("rank < need").select("slot", "need_before", "rank"))
    got = per_chunk.groupBy("need_before").agg(F.sum("n").alias("got"))
    left_out = (plan.select("need_before", "need").join(got, "need_before", "left")
                .withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
                .select("need_before", F.explode(F.expr("sequence(got, need - 1)")).alias("rank"), "got")
                .select((F.lit(slots) + F.col("rank") - F.col("got")).alias("slot"), "need_before", "rank"))
    return (ranked.unionByName(left_out).join(plan.drop("row_no"), "need_before")
            .withColumn("epoch", F.expr("rank div blocks")).withColumn("block_no", F.expr("rank % blocks"))
            .withColumn("tokens", F.least(F.lit(block), F.col("source_size") - F.col("block_no") * block,
                                          F.col("take") - F.col("epoch") * F.col("source_size") - F.col("block_no") * block))
            .select("slot", "source", "rank", "epoch", "block_no", "tokens"))


def mix(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
        max_epochs: int = 2, block: int = 1024, seed: int = 3) -> DataFrame:
    """What the mix takes of each document of the stored table ``sizes`` (uid, doc_id, source, size).

    Returns uid, doc_id, source, size, source_size, target, taken.
    """
    targets = materialize(spark, source_targets(spark, sizes, weights, share, max_epochs), "mix-targets")
    slots = schedule(spark, targets, block).withColumnRenamed("source", "_s")
    streams = source_streams(spark, sizes.where("size > 0"), seed)
    pieces = (streams.withColumn("block_no", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
              .withColumn("lo", F.greatest(F.col("start") - F.col("block_no") * block, F.lit(0)))
              .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block_no") * block, F.lit(block))))
    words = F.least("hi", F.coalesce("tokens", F.lit(0))) - F.col("lo")
    taken = (pieces.join(slots.select("_s", F.col("block_no").alias("_b"), "tokens").hint("merge"),
                         F.col("source").eqNullSafe(F.col("_s")) & (F.col("block_no") == F.col("_b")), "left")
             .groupBy("uid", "doc_id", "source", "size").agg(F.sum(F.greatest(words, F.lit(0))).alias("taken")))
    without_words = sizes.where("size = 0").select("uid", "doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    per_source = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return (taken.unionByName(without_words).join(per_source, F.col("source").eqNullSafe(F.col("_s")))
            .select("uid", "doc_id", "source", "size", "source_size", "target", "taken"))


def document_sizes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The stored table that :func:`mix` reads: one scan of the texts, which no later step reads again."""
    return materialize(spark, docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "source",
                                          n_words(F.col("text")).alias("size")), "mix-sizes")
