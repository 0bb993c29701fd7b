"""Operator 1, exact top-k search by inner product: three phases with a uniform threshold.

The components of a vector are dealt to ``lists`` equal slices; a slice's partial inner
products with a query are one local score list, and the score is their sum.

1. Every block of vectors gathers, for each query and list, its highest entries; the entries
   that lead a list anywhere are scored exactly. The k-th best of these scores is a safe
   cutoff t: the answer's last score is at least t.
2. The cutoff goes to all blocks. A vector that scores t or more has an entry of at least
   t / lists in some list (else its sum stayed below t), so the entries that reach this
   uniform threshold are sufficient.
3. The scores of what was collected are completed from the other lists, exactly, in the
   block that holds the vector; what reaches t goes into the final ranking.

Vectors and queries are packed into blocks and every block of vectors meets every block of
queries in one task: a stated query set against all rows. The lists of a block lie in one
task, so phases 2 and 3 share a scan and only k entries or a few more per query leave it.
Equal vectors are searched once, through the k + 1 smallest ids of each distinct vector
(of which a query's own row may take one); so a vector with very many copies stays cheap.

Vectors that are null or hold null or non-finite components take no part, as query or
candidate. Vectors of different length have no score with each other; two empty vectors
score 0. Ties go to the smaller id, null ids last. Repeated rows are rows of their own: a
query skips its own row and no other. Fewer candidates than k give fewer results. Integer
scores are exact while they fit 63 bits. Names of other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import materialize, ship

BLOCK = 2048
_PACKED = "dim int, n int, width int, ids binary, data binary, cutoffs binary"
_NO_CUTOFF = -(1 << 62)


def quantized(vec: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null if the vector cannot take part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vec.isNull() | bad, F.lit(None)).otherwise(F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (cls, vec, cutoff) to blocks of up to ``size`` vectors of one length, in the narrowest integers that hold them."""
    held: dict[int, list] = {}

    def block(dim: int, rows: list) -> pa.RecordBatch:
        data = np.array([r[1] for r in rows], dtype=np.int64).reshape(len(rows), dim)
        top = int(np.abs(data).max(initial=0))
        width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
        values = [dim, len(rows), width, np.array([r[0] for r in rows], dtype="<i8").tobytes(), data.astype(f"<i{width}").tobytes(),
                  np.array([r[2] for r in rows], dtype="<i8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, [pa.int32()] * 3 + [pa.binary()] * 3)],
                                          names=["dim", "n", "width", "ids", "data", "cutoffs"])

    for b in batches:
        for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            own = held.setdefault(len(row[1]), [])
            own.append(row)
            if len(own) == size:
                yield block(len(row[1]), held.pop(len(row[1])))
    for dim, rows in held.items():
        yield block(dim, rows)


def _blocks(spark: SparkSession, vectors: DataFrame, size: int, name: str) -> DataFrame:
    packed = vectors.select("cls", "vec", "cutoff").mapInArrow(lambda it: _packed(it, size), _PACKED)
    return materialize(spark, packed.withColumn("block", F.monotonically_increasing_id()), name)


def _meet(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of vectors beside every block of queries of its length: both are dealt to a
    grid, so that a cell holds about one pair, and joined by cell."""
    rows, cols = max(1, blocks.count()), max(1, queries.count())
    cells = min(rows * cols, 100_000)
    left = (blocks.select("dim", *[F.col(c).alias(f"v_{c}") for c in ("width", "ids", "data")],
                          F.expr(f"pmod(xxhash64(block), {rows})").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col")))
    right = (queries.select("dim", *[F.col(c).alias(f"q_{c}") for c in ("width", "ids", "data", "cutoffs")],
                            F.expr(f"pmod(xxhash64(block), {cols})").cast("int").alias("col"), F.explode(F.expr(f"sequence(0L, {rows - 1}L)")).alias("row")))
    keys = ["dim", "row", "col"]
    return left.repartition(cells, *keys).join(right.repartition(cells, *keys), keys).select(
        "dim", "v_width", "v_ids", "v_data", "q_width", "q_ids", "q_data", "q_cutoffs")


def _partials(row: dict, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(query classes, cutoffs, vector classes, partial products by list) of one pair of blocks."""
    dim = row["dim"]
    v_ids, q_ids = np.frombuffer(row["v_ids"], dtype="<i8"), np.frombuffer(row["q_ids"], dtype="<i8")
    v = np.frombuffer(row["v_data"], dtype=f"<i{row['v_width']}").reshape(len(v_ids), dim)
    q = np.frombuffer(row["q_data"], dtype=f"<i{row['q_width']}").reshape(len(q_ids), dim)
    top = int(np.abs(v.astype(np.int64)).max(initial=0)) * int(np.abs(q.astype(np.int64)).max(initial=0)) * max(1, dim)
    kind = np.float64 if top < 1 << 53 else np.int64  # float64 holds every sum exactly below 2**53
    cuts = [dim * j // lists for j in range(lists + 1)]
    parts = [(q[:, a:b].astype(kind) @ v[:, a:b].astype(kind).T).astype(np.int64) for a, b in zip(cuts, cuts[1:])]
    return q_ids, np.frombuffer(row["q_cutoffs"], dtype="<i8"), v_ids, parts


def _entries(pairs: DataFrame, pick) -> DataFrame:
    """Entries (query, cls, score) that ``pick`` chooses from each pair of blocks, with exact scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}
                q_ids, v_ids, at, score = pick(row)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at[0]]), pa.array(v_ids[at[1]]), pa.array(score)], names=["query", "cls", "score"])

    return pairs.mapInArrow(run, "query long, cls long, score long")


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, lists: int = 2, block: int = BLOCK) -> DataFrame:
    """The ``k`` highest scores of every query among all other rows of ``vectors`` (id, vec of long).

    ``is_query`` chooses the queries. Returns query_id, rank (from 1), id, score.
    """
    ship(spark)
    keep = k + 1  # one may be the query's own row
    rows = materialize(spark, vectors.where("vec IS NOT NULL").select("id", "vec", F.coalesce(is_query, F.lit(False)).alias("asks"),
                                                                      F.monotonically_increasing_id().alias("uid")), "topk-rows")
    by_id = [F.col("id").asc_nulls_last(), F.col("uid").asc()]
    # The rank limit is applied before the shuffle as well, so copies of one vector do not pile up.
    first = (rows.withColumn("at", F.row_number().over(Window.partitionBy("vec").orderBy(*by_id))).where(F.col("at") <= keep)
             .groupBy("vec").agg(F.min("uid").alias("cls"), F.collect_list(F.struct("id", "uid")).alias("members")))
    classes = materialize(spark, first, "topk-classes").withColumn("cutoff", F.lit(_NO_CUTOFF))
    asking = rows.where("asks")
    asked = materialize(spark, asking.select("vec").distinct().join(classes.select("vec", "cls"), "vec"), "topk-queries")
    blocks = _blocks(spark, classes, block, "topk-blocks")

    def leaders(row: dict):
        """Phase 1: the entries that lead a list of this block, for each query."""
        q_ids, _, v_ids, parts = _partials(row, lists)
        n = min(keep, len(v_ids))
        lead = np.concatenate([np.argpartition(-p, n - 1, axis=1)[:, :n] for p in parts], axis=1)
        lead.sort(axis=1)
        fresh = np.ones(lead.shape, dtype=bool)
        fresh[:, 1:] = lead[:, 1:] != lead[:, :-1]
        at = np.nonzero(fresh)[0], lead[fresh]
        return q_ids, v_ids, at, sum(p[at] for p in parts)

    def sufficient(row: dict):
        """Phases 2 and 3: entries at the uniform threshold, their scores completed, those at the cutoff."""
        q_ids, cutoffs, v_ids, parts = _partials(row, lists)
        share = -(-cutoffs // lists)[:, None]  # the least integer that is no less than cutoff / lists
        at = np.nonzero(np.logical_or.reduce([p >= share for p in parts]))
        score = sum(p[at] for p in parts)
        kept = score >= cutoffs[at[0]]
        return q_ids, v_ids, (at[0][kept], at[1][kept]), score[kept]

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("cls"))
    ask_blocks = _blocks(spark, asked.withColumn("cutoff", F.lit(_NO_CUTOFF)), block, "topk-query-blocks")
    seen = _entries(_meet(blocks, ask_blocks), leaders)
    cutoff = (seen.withColumn("at", F.row_number().over(best)).where(F.col("at") <= keep)
              .groupBy("query").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") == keep))
    bounded = (asked.join(cutoff, asked["cls"] == cutoff["query"], "left")
               .select("vec", "cls", F.coalesce("kth", F.lit(_NO_CUTOFF)).alias("cutoff")))
    cut_blocks = _blocks(spark, bounded, block, "topk-cutoff-blocks")
    found = materialize(spark, _entries(_meet(blocks, cut_blocks), sufficient), "topk-found")

    listed = found.join(classes.select("cls", "members"), "cls").select("query", "score", F.inline("members"))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid")]
    listed = listed.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("at") <= keep)
    own = asking.join(asked.withColumnRenamed("cls", "query"), "vec").select(F.col("id").alias("query_id"), F.col("uid").alias("own"), "query")
    ranked = (own.join(listed, "query").where("uid <> own")
              .withColumn("rank", F.row_number().over(Window.partitionBy("own").orderBy("at"))).where(F.col("rank") <= k))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
