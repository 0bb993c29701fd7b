"""The corpus pipeline: five operators applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's documents. All but the last return the columns of
``docs``, whatever these are, beyond doc_id, text and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import bpe, mixing, quality_model, quality_rules, simhash
from tripflow.llm.common import materialize, numbered, table
from tripflow.llm.queries import GOOD, N_GRADES, label_grades, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps.

    Texts without features (null, empty, white space) are judged by the thresholds alone. Long texts are judged whole;
    rows that repeat an id are judged each by its own text. Without ratings all documents stay."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
    judged = quality_model.classify(spark, docs.select("doc_id", rest.alias("rest"), "text"), label_grades(spark, sf_dir), N_GRADES, GOOD, keep_text=True)
    return judged.where("kept").select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in docs.columns])


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy keeps.

    Texts without words (null, empty, white space) fail its least number of words. Length rejects no text; repeated rows
    are measured each for itself."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    ledger = quality_rules.ledger(docs.select("text", row.alias("doc"))).select("doc", "fail_bits")
    stored = materialize(spark, ledger, "rules-ledger")
    return quality_rules.apply_policy(stored, quality_rules.POLICIES["v3"]).where("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the smallest doc_id (null last), of equals any one.

    Texts without words have the fingerprint zero and are one component with what is near it. Long texts are hashed whole.
    A column ``_row`` raises, as it is the stage's own."""
    own = numbered(spark, docs, "_row", "dedup-input")
    found = simhash.near_duplicates(spark, own, ["_row", "doc_id"])
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))).alias("first"))
    return own.join(first.select(F.col("first._row").alias("_row")), "_row", "left_semi").drop("_row")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, as rows: the whole document once for each epoch that takes all of it,
    and its beginning for the epoch that stops within it (at most one document of a source), cut after the last word taken.

    So the rows of a source hold exactly its ``taken`` words. The other columns are the document's, also on a cut row.
    Documents without words (null, empty, white space) give the mix nothing and have no row. Repeated rows are documents
    of their own. Columns ``_row``, ``_copy`` and ``_words`` raise, as they are the stage's own."""
    clash = {"_copy", "_words"} & set(docs.columns)
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    own = numbered(spark, docs, "_row", "mix-input")
    sizes = materialize(spark, own.select(F.col("_row").alias("uid"), "doc_id", "source", mixing.n_words(F.col("text")).alias("size")), "mix-sizes")
    taken = mixing.mix(spark, sizes).where("taken > 0")
    copies = taken.select(F.col("uid").alias("_row"), F.explode(F.expr("sequence(1, (taken + size - 1) div size)")).alias("_copy"),
                          F.when(F.expr("taken % size > 0"), F.expr("taken div size")).alias("_whole"), F.expr("taken % size").alias("_part"))
    copies = copies.select("_row", "_copy", F.when(F.col("_copy") > F.col("_whole"), F.col("_part")).alias("_words"))
    cut = F.when(F.col("_words").isNull(), F.col("text")).otherwise(mixing.first_words(F.col("text"), F.col("_words")))
    return own.join(copies, "_row").withColumn("text", cut).select(*[f"`{c}`" for c in docs.columns])


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and whether they decode to its text.

    Null and empty texts have no ids and decode. Long texts are encoded whole, repeated rows each for itself. Columns other
    than doc_id and source end here."""
    coded = bpe.codec(spark, docs.select("doc_id", "source", "text"), vocabulary(), decoded=None, decodes="decodes")
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decodes")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mixing_sources),
    ("bpe encoding", bpe_tokens),
]

#: A trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query ``pipeline``."""
    return run(spark, sf_dir)
