"""Run manifest (J6): what every stage of a run was made from, so that a rerun skips what is done.

One small JSON file a stage and feed below ``{lake}/_manifest``, written after the stage's table is complete:
the fingerprint of its input and parameters, that of its output, and its rows. A stage is done if both still
hold: the input has the same files in the same state, and the output is what the stage left there.

A fingerprint is the number of files, the sum of their bytes and the xor of a hash of (path, bytes, time) over
the input's folders. Spark lists the folders and aggregates; one row reaches the driver.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import filesystem


@dataclass(frozen=True)
class Entry:
    inputs: str
    output: str
    rows: int
    location: str


def fingerprint(spark: SparkSession, paths: list[str], *parameters: object) -> str:
    """State of all files below ``paths`` together with the parameters (by their repr). Paths that do not exist count as empty."""
    there = sorted(p for p in paths if filesystem(spark, p)[0].exists(filesystem(spark, p)[1]))
    state = "0"
    if there:
        # Names alone are read, never the content.
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there).select("path", "length", "modificationTime")
        row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime")))).first()
        state = "/".join(map(str, row))
    return f"{state}/{hashlib.sha256(repr((sorted(paths), parameters)).encode()).hexdigest()[:16]}"


def frame_fingerprint(spark: SparkSession, df: DataFrame, *parameters: object) -> str:
    """Fingerprint of the files that a frame reads, and of what it computes from them."""
    return fingerprint(spark, [p for p in df.inputFiles()], df.schema.json(), *parameters)


class Manifest:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, f"{root.rstrip('/')}/_manifest"

    def _path(self, stage: str, feed: str) -> str:
        return f"{self.root}/{stage}.{feed}.json"

    def entry(self, stage: str, feed: str) -> Entry | None:
        fs, p = filesystem(self.spark, self._path(stage, feed))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Entry(**json.loads(text))
        except (ValueError, TypeError):  # a broken entry is none
            return None

    def done(self, stage: str, feed: str, inputs: str) -> Entry | None:
        """The entry of a stage that was finished from this input and whose output is untouched."""
        held = self.entry(stage, feed)
        if held is None or held.inputs != inputs or held.output != fingerprint(self.spark, [held.location]):
            return None
        return held

    def finish(self, stage: str, feed: str, inputs: str, location: str, rows: int) -> None:
        entry = Entry(inputs, fingerprint(self.spark, [location]), rows, location)
        fs, p = filesystem(self.spark, self._path(stage, feed))
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(asdict(entry)).encode()))
        out.close()
