"""Incremental Bronze ingest (J1 as a stream), equal to the batch ingest month by month.

Landed months arrive over time, and a month may land again. The Structured Streaming query over the
landing folder (``availableNow``, or every minute) finds new files and says which months they belong to;
each micro-batch then replaces those months as a whole by the same code as the batch ingest. So a
backup copy is no month, a zero-byte or unreadable month is one status row and does not stop the others, and
a month that landed again replaces its rows.

The ledger (``_state/ledger`` in the Bronze folder) says for every landed file in which state (size, time) it was
ingested, by which batch, with what outcome. A month is ingested if the state of its files differs from the
ledger's. A batch that Spark runs again after a failure therefore does nothing, or replaces the same months
by the same rows. A file that is overwritten under its old name is no new file to Spark's source: the
pass at the end of :func:`run_bronze_ingest_once` compares the whole listing with the ledger and finds it.
A file that is gone from the landing folder leaves Bronze as it is, unless others of its month are still there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.plans.medallion import load_months
from tripflow.session import filesystem, scratch_path
from tripflow.sources.landing import LandedFile, month_regex, list_landing
from tripflow.specs import FeedSpec

LEDGER_SCHEMA = "path string, size long, time long, mes string, batch long, status string, linhas long, erro string"


def landing_stream(spark: SparkSession, spec: FeedSpec, landing_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming scan of ``{landing_dir}/*{prefix}_*`` (files or month folders) that reads no column: one row
    (path) for each landed row. A file without a readable footer gives none."""
    pattern = f"{landing_dir.rstrip('/')}/*{spec.prefix}_*"
    return (spark.readStream.schema(spec.bronze_schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").parquet(pattern)
            .select(F.col("_metadata.file_path").alias("path")))


class BronzeIngest:
    """What the stream does with a batch: replaces the changed months among its files."""

    def __init__(self, spark: SparkSession, spec: FeedSpec, landing_dir: str, bronze_path: str, months_per_pass: int = 64) -> None:
        self.spark, self.spec, self.landing, self.bronze = spark, spec, landing_dir, bronze_path.rstrip("/")
        self.ledger_path, self.months_per_pass = f"{self.bronze}/_state/ledger", months_per_pass
        self.rows = 0  # written so far
        if self._exists(f"{self.bronze}/_spark_metadata"):
            raise ValueError(f"{self.bronze} was written by a file sink, whose log hides replaced months: use a new folder")

    def _exists(self, path: str) -> bool:
        fs, p = filesystem(self.spark, path)
        return fs.exists(p)

    def ledger(self) -> DataFrame:
        """The last entry of every landed file."""
        if not self._exists(self.ledger_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = self.spark.read.schema(f"{LEDGER_SCHEMA}, entry long").parquet(self.ledger_path)
        columns = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
        last = rows.groupBy("path").agg(F.max_by(F.struct(*columns), "entry").alias("last"))
        return last.select(*[f"last.{c}" for c in columns])

    def changed(self) -> list[LandedFile]:
        """The files of all months of which a file is new, gone or in another state than the ledger's."""
        files = list_landing(self.spark, self.landing, self.spec.prefix, times=True)
        # One entry a landed month file: the driver lists them anyway.
        known = {r.path: (r.size, r.time, r.mes) for r in self.ledger().collect()}
        now = {f.path: (f.size, f.time, f.month) for f in files}
        months = {f.month for f in files if known.get(f.path) != now[f.path]}
        months |= {month for path, (_, _, month) in known.items() if path not in now} & {f.month for f in files}
        return [f for f in files if f.month in months]

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """The months of one micro-batch's files."""
        # One path a file is left before any month is looked for: the stream has a row for every landed row.
        paths = [r.path for r in rows.select("path").distinct().collect()]
        found = (re.fullmatch(f"(?s).*{month_regex(self.spec.prefix)}.*", path) for path in paths)
        landed = {f"{m[1]}-{m[2]}" for m in found if m}
        self._load([f for f in self.changed() if f.month in landed], batch_id)

    def reconcile(self, batch_id: int = -1) -> None:
        """All months that differ from the ledger, some at a time."""
        while files := self.changed():
            months = sorted({f.month for f in files})[:self.months_per_pass]
            self._load([f for f in files if f.month in months], batch_id)

    def _load(self, files: list[LandedFile], batch_id: int) -> None:
        if not files:
            return
        held = {}
        if any(st.isDirectory() and st.getPath().getName().startswith("partition_year=") for st in self._list()):
            held = dict(self.spark.read.option("mergeSchema", "true").parquet(self.bronze).dtypes)
        months = tuple(sorted({f.month for f in files}))
        status, _ = load_months(self.spark, self.spec, files, self.bronze, held, months)
        of = {mes: (state, n, error) for _, mes, state, n, error in status}
        entries = [(f.path, f.size, f.time, f.month, batch_id, *of[f.month]) for f in files]
        # Files that are gone from these months are entered as they are now, else the months would differ for ever.
        here = {f.path for f in files}
        entries += [(r.path, -1, -1, "", batch_id, "gone", 0, None) for r in self.ledger().where(F.col("mes").isin(*months)).collect() if r.path not in here]
        self._enter(entries)
        self.rows += sum(n for _, n, _ in of.values())

    def _list(self):
        fs, p = filesystem(self.spark, self.bronze)
        return fs.listStatus(p) if fs.exists(p) else []

    def _enter(self, entries: list[tuple]) -> None:
        """One new folder of the ledger, after the months are written."""
        fs, p = filesystem(self.spark, self.ledger_path)
        names = [st.getPath().getName() for st in (fs.listStatus(p) if fs.exists(p) else [])]
        at = 1 + max((int(n.removeprefix("entry=")) for n in names if n.startswith("entry=")), default=-1)
        self.spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.ledger_path}/entry={at:012d}")


def start_bronze_ingest(
    spark: SparkSession,
    spec: FeedSpec,
    landing_dir: str,
    bronze_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int = 64,
    ingest: BronzeIngest | None = None,
) -> StreamingQuery:
    """Start the incremental ingest; with ``available_now`` it stops by itself once every new file has been
    seen. The checkpoint defaults to the shared folder of ``spark.checkpoint.dir``."""
    checkpoint = checkpoint or scratch_path(spark, "streams", f"bronze_{spec.tag}", unique=False)
    ingest = ingest or BronzeIngest(spark, spec, landing_dir, bronze_path)
    writer = (landing_stream(spark, spec, landing_dir, max_files_per_trigger)
              .writeStream.foreachBatch(ingest.batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_bronze_ingest_once(spark: SparkSession, spec: FeedSpec, landing_dir: str, bronze_path: str,
                           checkpoint: str | None = None) -> int:
    """Run one ``availableNow`` pass to completion and take in what it cannot see; returns the rows written."""
    ingest = BronzeIngest(spark, spec, landing_dir, bronze_path)
    q = start_bronze_ingest(spark, spec, landing_dir, bronze_path, checkpoint, ingest=ingest)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    ingest.reconcile()
    return ingest.rows
