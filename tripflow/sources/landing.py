"""Monthly landing files (S1-S5, S3 guard, A6, A13).

A feed lands as one Parquet file (or Spark output directory) per month whose
path contains ``{prefix}_{YYYY-MM}``; the month comes from the path, never from
the data. Every month is read with its own footer schema (merged over all its part
files), lower-cased and soft-cast, and the months are united by name: columns the
spec does not know stay, a month with an odd type or an unreadable file is one bad
month and not the end of the others. Months of one schema share a scan.

Listing uses the Hadoop FileSystem API, so the same code runs on any store
Spark can read. It asks once per month entry for its size and never walks the part
files, which Spark itself lists in parallel.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.ingest import to_bronze
from tripflow.session import filesystem
from tripflow.sources.footers import entry_footers
from tripflow.specs import COLUNAS, FALHAS, LINHAS, MES, SUCESSOS, TAMANHO_MB, FeedSpec

#: What Spark raises for a file that it cannot read or a schema that it cannot resolve.
READ_ERRORS = (PySparkException, Py4JError, ValueError)


@dataclass(frozen=True)
class LandedFile:
    month: str  # 'YYYY-MM'
    path: str  # the month's file or folder
    size: int
    time: int = 0  # when it, or the last file in it, was written (milliseconds); 0 if not asked for


def month_file(root: str, prefix: str, month: str) -> str:
    """S2: 'YYYY-MM' -> ``{root}/{prefix}_{YYYY-MM}.parquet``."""
    return f"{root.rstrip('/')}/{prefix}_{month}.parquet"


def month_parts(month: str) -> tuple[int, int]:
    """S2: 'YYYY-MM' -> (year, month) as ints, no zero padding."""
    year, mon = month.split("-")
    return int(year), int(mon)


def month_regex(prefix: str) -> str:
    return re.escape(prefix) + r"_(\d{4})-(\d{2})"


def list_landing(spark: SparkSession, root: str, prefix: str, times: bool = False) -> list[LandedFile]:
    """Every month entry (a file, or a folder of part files) of the feed under ``root``
    or one folder below it (``root/<tag>/``), with its month and byte size.

    The whole name must be ``{prefix}_{YYYY-MM}`` (with ``.parquet``, or as the value of a
    ``landing_file=`` folder): backups and temporary copies are not months. Zero-byte
    entries are listed too, for the empty-file guard. With ``times`` the time of the last
    change is looked up as well (a folder costs a listing of its files).
    """
    fs, _ = filesystem(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    name = re.compile(r"(?:landing_file=)?" + month_regex(prefix) + r"(?:\.parquet)?")
    out: dict[str, LandedFile] = {}
    for pattern in (f"{root.rstrip('/')}/*{prefix}_*", f"{root.rstrip('/')}/*/*{prefix}_*"):
        for st in fs.globStatus(path(pattern)) or []:
            m = name.fullmatch(st.getPath().getName())
            if m:
                size = fs.getContentSummary(st.getPath()).getLength() if st.isDirectory() else st.getLen()
                time = 0
                if times:
                    parts = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
                    time = max((int(p.getModificationTime()) for p in parts), default=0)
                out[st.getPath().toString()] = LandedFile(f"{m.group(1)}-{m.group(2)}", st.getPath().toString(), int(size), time)
    return sorted(out.values(), key=lambda f: (f.month, f.path))


def _paths_by_month(files: list[LandedFile]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for f in files:
        if f.size > 0:
            out.setdefault(f.month, []).append(f.path)
    return out


def _reason(exc: Exception) -> str:
    """The first line of what went wrong; of a Java error, of the cause at its root."""
    cause = getattr(exc, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    lines = [x for x in (str(exc) if cause is None else cause.toString()).splitlines() if x.strip()]
    return f"{type(exc).__name__}: {lines[0] if lines else ''}"[:300]


def _concurrently(fn, items: list):
    """``fn`` of every item; footers of different months are read at the same time."""
    with ThreadPoolExecutor(max_workers=max(1, min(16, len(items)))) as pool:
        return list(pool.map(fn, items))


@dataclass(frozen=True)
class MonthRead:
    """How one month is read: its schema, its paths if these read as one, its rows if its footers told them, and its scan
    if finding the schema has made one."""

    schema: T.StructType
    paths: tuple[str, ...] | None
    rows: int | None = None
    found: DataFrame | None = None

    def scan(self, spark: SparkSession) -> DataFrame:
        return self.found if self.found is not None else spark.read.schema(self.schema).parquet(*self.paths)


def _month_read(df: DataFrame, paths: tuple[str, ...] | None) -> MonthRead:
    return MonthRead(df.schema, paths, found=df)


def _months_alike(spark: SparkSession, by_month: dict[str, list[str]]) -> dict[str, MonthRead]:
    """The months whose part files all have one schema key: one job reads all footers, and Spark resolves each key's schema
    from one file. The others (parts that disagree, deeper folders, no whole footer, a store closed to Python) are absent."""
    if len(by_month) < 2:
        return {}
    try:
        found = entry_footers(spark, [p for paths in by_month.values() for p in paths])
    except READ_ERRORS:  # an entry is gone: each month tells for itself
        return {}
    alike: dict[str, list[str]] = {}
    for month, paths in by_month.items():
        keys = {found[p].key if p in found else None for p in paths}
        if len(keys) == 1 and None not in keys:
            alike.setdefault(keys.pop(), []).append(month)

    def resolve(months: list[str]):
        try:
            return months, spark.read.parquet(found[by_month[months[0]][0]].sample).schema
        except READ_ERRORS:
            return months, None

    return {m: MonthRead(schema, tuple(by_month[m]), sum(found[p].rows for p in by_month[m]))
            for months, schema in _concurrently(resolve, list(alike.values())) if schema is not None and not name_collisions(schema) for m in months}


def read_months(spark: SparkSession, files: list[LandedFile], errors: dict[str, str] | None = None) -> dict[str, MonthRead]:
    """Month -> its files as they are, with the schema merged over all their footers.

    The footers of all months are read by one job; only a month whose part files have different schemas or an unreadable
    footer is read by itself. A month that Spark cannot read goes into ``errors`` (or raises, without ``errors``). If the part
    files of a month disagree on a type, each is read on its own, whatever its ending, and the parts are united.
    """
    by_month = _paths_by_month(files)
    out = _months_alike(spark, by_month)

    def read(item):
        month, paths = item
        try:
            return month, _month_read(spark.read.option("mergeSchema", "true").parquet(*paths), tuple(paths)), None
        except READ_ERRORS as exc:
            try:
                parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true")  # hidden files are left out
                names = [r.path for r in parts.load(paths).where("length > 0").select("path").collect()]  # of one month
                if len(names) < 2:
                    raise exc
                return month, _month_read(united([_settled(spark.read.parquet(n)) for n in sorted(names)]), None), None
            except READ_ERRORS as inner:
                return month, None, inner

    for month, found, exc in _concurrently(read, sorted((m, p) for m, p in by_month.items() if m not in out)):
        pairs = name_collisions(found.schema) if exc is None else []
        if exc is None and not (pairs and errors is not None):
            out[month] = found
        elif errors is None:
            raise exc
        else:
            errors[month] = ("columns collide after lower-casing: " + ", ".join(f"{a}/{b}" for a, b in pairs)) if pairs else f"unreadable: {_reason(exc)}"
    return out


def month_scans(spark: SparkSession, files: list[LandedFile], errors: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Month -> scan of all its files as they are (see :func:`read_months`)."""
    return {month: r.scan(spark) for month, r in read_months(spark, files, errors).items()}


def month_schemas(spark: SparkSession, files: list[LandedFile], errors: dict[str, str] | None = None) -> dict[str, T.StructType]:
    """Footer schema per month, merged over all its part files (metadata only; no row is read).
    Zero-byte months have none."""
    return {month: r.schema for month, r in read_months(spark, files, errors).items()}


def _settled(df: DataFrame) -> DataFrame:
    """Lower-case names, so that parts which differ in case alone unite."""
    return df.toDF(*[c.lower() for c in df.columns])


def united(frames: list[DataFrame], known: dict[str, str] | None = None) -> DataFrame:
    """Union by lower-case name. A column whose types differ takes the type in ``known``, else the
    widest number type if all are numbers, else text; a column without any type becomes text."""
    kinds = unified_types([f.schema for f in frames], known)
    shaped = [f.select([F.col(c).try_cast(kinds[c]).alias(c) if t != kinds[c] else F.col(c) for c, t in f.dtypes]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)


_WIDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def unified_types(schemas: list[T.StructType], known: dict[str, str] | None = None) -> dict[str, str]:
    """Column -> one type for all ``schemas`` (see :func:`united`)."""
    seen: dict[str, set[str]] = {}
    for schema in schemas:
        for f in schema.fields:
            seen.setdefault(f.name, set()).add(f.dataType.simpleString())
    out = {}
    for name, kinds in seen.items():
        kinds.discard("void")
        if known and name in known:
            out[name] = known[name]
        elif len(kinds) == 1:
            out[name] = kinds.pop()
        elif kinds and kinds <= set(_WIDER):
            out[name] = "double" if kinds & {"float", "double"} and kinds & {"bigint", "int", "double"} else max(kinds, key=_WIDER.index)
        else:
            out[name] = "string"
    return out


def delivered(df: DataFrame, spec: FeedSpec, year, month) -> DataFrame:
    """Landed rows with lower-case names and the month, in the types they came in."""
    rows = _settled(df.drop("partition_year", "partition_month"))
    return rows.select(*[c for c in rows.columns if c not in ("_year", "_month")], year.alias("partition_year"), month.alias("partition_month"))


def bronze_of(df: DataFrame, spec: FeedSpec, year, month) -> DataFrame:
    """Landed rows as Bronze rows: lower-case, soft-cast, every column of the spec (null if they
    lack it), unknown columns kept, the month as int partition columns."""
    bronze = to_bronze(df.drop("partition_year", "partition_month"), spec)
    bronze = bronze.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in spec.bronze_types if c not in bronze.columns])
    known = [c for c, _ in spec.bronze_types]
    rest = [c for c in bronze.columns if c not in known and c not in ("_year", "_month")]
    return bronze.select(*known, *rest, year.alias("partition_year"), month.alias("partition_month"))


def month_groups(spark: SparkSession, spec: FeedSpec, reads: dict[str, MonthRead], shape=bronze_of) -> list[tuple[list[str], DataFrame]]:
    """(months, rows in ``shape``) of all months that share a schema, by one scan each.

    The month of a single one is a constant; in a scan of several it is cut from the file's path
    (the seven characters after the last ``{prefix}_``).
    """
    alike: dict[str, list[str]] = {}
    for month, r in sorted(reads.items()):
        alike.setdefault(r.schema.json() if r.paths else month, []).append(month)
    out = []
    for months in alike.values():
        first = reads[months[0]]
        if len(months) == 1:
            year, mon = month_parts(months[0])
            out.append((months, shape(first.scan(spark), spec, F.lit(year), F.lit(mon))))
            continue
        label = F.substring_index(F.col("_metadata.file_path"), f"{spec.prefix}_", -1)
        df = (spark.read.schema(first.schema).parquet(*[p for m in months for p in reads[m].paths])
              .withColumn("_year", F.substring(label, 1, 4).cast("int")).withColumn("_month", F.substring(label, 6, 2).cast("int")))
        out.append((months, shape(df, spec, F.col("_year"), F.col("_month"))))
    return out


def scan_landing(spark: SparkSession, spec: FeedSpec, root: str, months: tuple[str, ...] | None = None,
                 files: list[LandedFile] | None = None) -> DataFrame:
    """The landed months of a feed as Bronze rows, all of them unless ``months`` names some.

    Columns: the spec's, the unknown ones, and ``partition_year``/``partition_month``.
    """
    files = list_landing(spark, root, spec.prefix) if files is None else files
    groups = month_groups(spark, spec, read_months(spark, [f for f in files if months is None or f.month in months]))
    if not groups:
        return spark.createDataFrame([], T.StructType([*spec.bronze_schema, T.StructField("partition_year", T.IntegerType()),
                                                       T.StructField("partition_month", T.IntegerType())]))
    return united([df for _, df in groups])


def with_file_month(df: DataFrame, spec: FeedSpec, path_col: str) -> DataFrame:
    """Add int ``partition_year``/``partition_month`` parsed from a path column
    (the last ``{prefix}_YYYY-MM`` in the path: the file or its month folder)."""
    rx = ".*" + month_regex(spec.prefix)
    return df.withColumn("partition_year", F.regexp_extract(path_col, rx, 1).cast("int")).withColumn(
        "partition_month", F.regexp_extract(path_col, rx, 2).cast("int")
    )


def name_collisions(schema) -> list[tuple[str, str]]:
    """Pairs of column names that become equal after lower-casing (Trap: Spark
    cannot read such a file case-insensitively)."""
    seen: dict[str, str] = {}
    out = []
    for f in schema.fields:
        low = f.name.lower()
        if low in seen:
            out.append((seen[low], f.name))
        else:
            seen[low] = f.name
    return out


STATUS_SCHEMA = f"feed string, {MES} string, status string, {LINHAS} long, erro string"


def expected_months(spec: FeedSpec, files: list[LandedFile], months: tuple[str, ...] | None = None) -> list[str]:
    """The months asked for, or all of the spec and all that landed."""
    return sorted(set(months)) if months is not None else sorted({*spec.months, *(f.month for f in files)})


def unusable_months(spec: FeedSpec, files: list[LandedFile], wanted: list[str], errors: dict[str, str], feed: str) -> dict[str, tuple[str, str]]:
    """Month -> (status, reason) of the wanted months that cannot be read."""
    sizes: dict[str, int] = {}
    for f in files:
        sizes[f.month] = sizes.get(f.month, 0) + f.size
    out = {m: ("missing", f"no file for {spec.prefix}_{m}") for m in wanted if m not in sizes}
    out |= {m: ("empty", f"empty file | feed={feed} | month={m}") for m in wanted if sizes.get(m) == 0}
    return out | {m: ("error", errors[m]) for m in wanted if m in errors}


def month_status(spark: SparkSession, spec: FeedSpec, root: str, feed: str | None = None,
                 files: list[LandedFile] | None = None, months: tuple[str, ...] | None = None) -> DataFrame:
    """A13 + S3 + S4: one row per expected or landed month: (feed, mes, status, linhas, erro).

    status is ``ok``, ``empty`` (only zero-byte files), ``missing`` (no file) or ``error`` (unreadable
    footers, or two columns that collide after lower-casing). Rows come from the job that reads the
    footers of all months. The result is a local frame: looking at it again scans nothing.
    """
    feed = feed or spec.tag
    files = list_landing(spark, root, spec.prefix) if files is None else files
    wanted = expected_months(spec, files, months)
    errors: dict[str, str] = {}
    counted = _rows_by_month(spark, spec, read_months(spark, [f for f in files if f.month in wanted], errors))
    bad = unusable_months(spec, files, wanted, errors, feed)
    rows = [(feed, m, bad[m][0], 0, bad[m][1]) if m in bad else (feed, m, "ok", counted.get(m, 0), None) for m in wanted]
    return spark.createDataFrame(rows, STATUS_SCHEMA).orderBy(MES)


def _rows_by_month(spark: SparkSession, spec: FeedSpec, reads: dict[str, MonthRead]) -> dict[str, int]:
    """Rows of every month: those its footers told, the other months from one job over all of them."""
    told = {m: r.rows for m, r in reads.items() if r.rows is not None}
    rest = {m: r for m, r in reads.items() if r.rows is None}
    if not rest:
        return told
    months = [df.select("partition_year", "partition_month") for _, df in month_groups(spark, spec, rest)]
    counts = reduce(DataFrame.unionAll, months).groupBy("partition_year", "partition_month").count()
    return told | {f"{y:04d}-{m:02d}": n for y, m, n in counts.collect()}  # one row per month


def ingest_tally(status: DataFrame) -> DataFrame:
    """Successes / failures per feed from a month-status frame."""
    return status.groupBy("feed").agg(
        F.count_if(F.col("status") == "ok").alias(SUCESSOS),
        F.count_if(F.col("status") != "ok").alias(FALHAS),
    )


def require_complete(status: DataFrame) -> None:
    """Strict mode: raise when any expected month is missing or empty."""
    bad = status.filter(F.col("status") != "ok").select("feed", MES, "status").collect()
    if bad:
        raise ValueError("incomplete landing: " + ", ".join(f"{r.feed}/{r.mes}:{r.status}" for r in bad))


def file_volume(spark: SparkSession, spec: FeedSpec, root: str, files: list[LandedFile] | None = None) -> DataFrame:
    """(feed, mes, linhas, colunas, tamanho_mb) of every readable landed month.

    Rows by a count, columns from the files' own footers, and the size from the listing,
    so that files without rows count as well.
    """
    files = list_landing(spark, root, spec.prefix) if files is None else files
    reads = read_months(spark, files, {})
    rows = _rows_by_month(spark, spec, reads)
    sizes = {m: sum(f.size for f in files if f.month == m) for m in reads}
    out = [(spec.tag, m, rows.get(m, 0), len(r.schema), round(sizes[m] / (1024 * 1024), 2)) for m, r in sorted(reads.items())]
    return spark.createDataFrame(out, f"feed string, {MES} string, {LINHAS} long, {COLUNAS} int, {TAMANHO_MB} double").orderBy(MES)


def landed_columns(spark: SparkSession, spec: FeedSpec, root: str, files: list[LandedFile] | None = None) -> DataFrame:
    """C1 in rows: (feed, mes, coluna, tipo, linhas), one row per readable landed month and column, named as delivered.

    Types and rows come from the footers of all months, read by one job. An unreadable month is absent;
    one without rows has its columns and 0. Also see :func:`tripflow.operators.schema_audit.schema_drift`.
    """
    files = list_landing(spark, root, spec.prefix) if files is None else files
    reads = read_months(spark, files, {})
    rows = _rows_by_month(spark, spec, reads)
    out = [(spec.tag, m, c, t, rows.get(m, 0)) for m, r in sorted(reads.items()) for c, t in ((f.name, f.dataType.simpleString()) for f in r.schema)]
    return spark.createDataFrame(out, f"feed string, {MES} string, coluna string, tipo string, {LINHAS} long")


def stored_bytes(spark: SparkSession, spec: FeedSpec, files: list[LandedFile]) -> DataFrame:
    """(mes, bytes) of the landed files as Spark lists them (lengths only; no content is read)."""
    paths = [f.path for f in files if f.size > 0]
    if not paths:
        return spark.createDataFrame([], f"{MES} string, bytes long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")
    mes = F.format_string("%04d-%02d", F.col("partition_year"), F.col("partition_month"))
    return with_file_month(found, spec, "path").groupBy(mes.alias(MES)).agg(F.sum("length").alias("bytes"))


def land_feed(raw: DataFrame, spec: FeedSpec, root: str, mode: str = "overwrite") -> str:
    """Write a raw feed into the landing layout in ONE distributed job: one
    directory per month named ``landing_file={prefix}_{YYYY-MM}``. The rebalance
    hint keeps one writer per month where possible and splits a hot month."""
    label = F.format_string(f"{spec.prefix}_%04d-%02d", F.col("partition_year"), F.col("partition_month"))
    out = f"{root.rstrip('/')}/{spec.tag}"
    (raw.withColumn("landing_file", label).drop("partition_year", "partition_month")
     .hint("rebalance", "landing_file")
     .write.mode(mode).partitionBy("landing_file").parquet(out))
    return out
