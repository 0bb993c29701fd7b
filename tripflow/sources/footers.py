"""The footers of all landed files as one table, read by one job on the executors.

Spark lists the part files; a task reads the footers of its files and no data page. Rows and row groups come from the footer,
and the schema as a key: files of one key have one Spark schema, so Spark resolves it from one of them and not once a month.

A store that Python cannot open on the executors (it opens local and mounted paths, ``hdfs``, ``s3``, ``s3a`` and ``gs``), or a
file without a whole footer, gives ``erro``; such months are read as Spark reads them, which also words the reason. No file is left out here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.specs import LINHAS

FOOTER_COLUMNS = f"path string, bytes long, {LINHAS} long, grupos int, esquema string, erro string"


def read_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per part file (hidden ones left out) of the files and folders ``paths``.

    (path, bytes, linhas, grupos, esquema, erro): rows, row groups and schema key, null where ``erro`` is not. Without paths
    there are no rows. Looking at the frame again reads the footers again.
    """
    if not paths:
        return spark.createDataFrame([], FOOTER_COLUMNS)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nested, so that it travels to the executors by value.
        import hashlib
        from urllib.parse import urlsplit

        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        stores: dict[tuple[str, str], pafs.FileSystem | Exception] = {}

        def store(uri: str):
            """The file system of ``uri`` (asked for once a task) and the path in it."""
            part = urlsplit(uri)
            if part.scheme in ("", "file"):
                return stores.setdefault(("", ""), pafs.LocalFileSystem()), uri.removeprefix("file:").replace("///", "/", 1)
            key = (part.scheme, part.netloc)
            if key not in stores:
                try:
                    stores[key] = pafs.FileSystem.from_uri(f"{part.scheme.replace('s3a', 's3')}://{part.netloc}/")[0]
                except (pa.ArrowException, OSError, ValueError) as exc:
                    stores[key] = exc
            if isinstance(stores[key], Exception):
                raise OSError(f"no way to {part.scheme}://{part.netloc}: {stores[key]}")
            return stores[key], part.path if part.scheme == "hdfs" else part.netloc + part.path

        def one(uri: str, size: int) -> tuple:
            try:
                fs, path = store(uri)
                with fs.open_input_file(path) as f:
                    meta = pq.read_metadata(f)
            except (pa.ArrowException, OSError, ValueError) as exc:
                return uri, size, None, None, None, f"{type(exc).__name__}: {exc}"[:300]
            # What Spark makes its schema of: the one it wrote itself, else the Parquet types (the first line is the object's address).
            own = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
            types = str(meta.schema).split("\n", 1)[1].encode()
            return uri, size, meta.num_rows, meta.num_row_groups, hashlib.sha256(own + b"\0" + types).hexdigest(), None

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        names = ["path", "bytes", "linhas", "grupos", "esquema", "erro"]
        for b in batches:
            rows = [one(p, n) for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=names)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    # Lengths from the listing: no content is read. A footer is little work, so few tasks take many files each.
    return (listed.select("path", "length").coalesce(4 * spark.sparkContext.defaultParallelism)
            .mapInArrow(footers, FOOTER_COLUMNS))


@dataclass(frozen=True)
class EntryFooters:
    """The footers of one landed entry (a file, or a folder of part files)."""

    rows: int
    files: int
    sample: str  # one of its part files
    key: str | None  # the schema key of all its part files; None if they differ, one has no footer, or one lies deeper


def entry_footers(spark: SparkSession, entries: list[str]) -> dict[str, EntryFooters]:
    """Entry -> its footers, summed up on the executors; one row an entry (and a deeper folder) reaches the driver.

    Entries without part files are absent."""
    known = spark.createDataFrame([(e,) for e in entries], "_entry string")
    found = read_footers(spark, entries).join(known, F.col("path") == F.col("_entry"), "left")
    entry = F.coalesce("_entry", F.regexp_replace("path", "/[^/]*$", ""))  # the file itself, or its folder
    grouped = (found.groupBy(entry.alias("entry"))
               .agg(F.sum(LINHAS).alias("rows"), F.count(F.lit(1)).alias("files"), F.min("path").alias("sample"),
                    F.min("esquema").alias("low"), F.max("esquema").alias("high"), F.count("erro").alias("bad")).collect())
    asked = set(entries)
    out = {r.entry: EntryFooters(r.rows or 0, r.files, r.sample, r.low if r.low == r.high and not r.bad else None) for r in grouped if r.entry in asked}
    # Part files in deeper folders: Spark would take columns from the folders' names, so it reads the entry itself.
    for r in grouped:
        if r.entry not in asked:
            for e in (e for e in asked if r.entry.startswith(e + "/")):
                out[e] = EntryFooters(0, 0, r.sample, None)
    return out
