"""Files in and out: CSV folders, panels, series, metric tables."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hourgrid.functions import geo
from hourgrid.functions.text import area_code
from hourgrid.operators.dedupe import first_per_key
from hourgrid.operators.shape import clean_names

SOURCE, POSITION = "source_file", "source_position"
# Fields in double quotes, quotes in them doubled, line breaks in them allowed.
CSV = {"header": True, "quote": '"', "escape": '"'}
#: Files that the driver opens at a time for their first line or footer.
OPENED = 32


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths of a folder's files, from the cluster's file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in system.listStatus(path)
                  if s.isFile() and s.getPath().getName().endswith(suffix))


def each(files: list[str], act) -> dict:
    """``act`` of each file, ``OPENED`` at a time."""
    with ThreadPoolExecutor(OPENED) as pool:
        return dict(zip(files, pool.map(act, files)))


def first_line(spark: SparkSession, file: str) -> str | None:
    """A file's first line, read from its beginning only; None if the file is empty."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        line = jvm.org.apache.hadoop.io.Text()
        return line.toString() if jvm.org.apache.hadoop.util.LineReader(stream).readLine(line) else None
    finally:
        stream.close()


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """First line → files that begin with it; the rest of the files is not read. Files without a line are left out."""
    found: dict[str, list[str]] = {}
    for file, header in each(sorted(files), lambda f: first_line(spark, f)).items():
        if header is not None:
            found.setdefault(header, []).append(file)
    return dict(sorted(found.items()))


def read_csv_folder(spark: SparkSession, folder: str, clean: bool = True, multi_line: bool = True) -> DataFrame:
    """All CSV files of a folder as text columns, united by name.

    Files are read together per distinct header, so each group is one scan. The file
    name and the row's place in it are kept to order the rows later. ``multi_line`` takes line
    breaks inside quotes, at the price of one task per file; without it large files are split.
    Files without a line are skipped.
    """
    files = list_files(spark, folder, ".csv")
    if not files:
        raise FileNotFoundError(f"no CSV file in {folder}")
    parts = []
    for members in csv_headers(spark, files).values():
        header = spark.read.options(**CSV).csv(members[0]).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        raw = spark.read.schema(schema).options(**CSV, multiLine=multi_line).csv(members)
        raw = raw.select("*", F.col("_metadata.file_name").alias(SOURCE), F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row")).alias(POSITION))
        parts.append(clean_names(raw) if clean else raw)
    return union_by_name(*parts)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine_incidents(df: DataFrame, key: str = "incident_number") -> DataFrame:
    """First row per incident in file order."""
    return first_per_key(df, [key], [SOURCE, POSITION])


def _format_of(system, path) -> str:
    """``parquet`` or ``csv``, by the first data file below the path."""
    found = system.listFiles(path, True)
    while found.hasNext():
        name = found.next().getPath().getName()
        if name.endswith((".parquet", ".csv")):
            return name.rsplit(".", 1)[1]
    return "csv"


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The path as it is, or with .parquet or .csv added: the first that exists."""
    context = spark.sparkContext
    for candidate in (path, f"{path}.parquet", f"{path}.csv"):
        target = context._jvm.org.apache.hadoop.fs.Path(candidate)
        system = target.getFileSystem(context._jsc.hadoopConfiguration())
        if system.exists(target):
            if _format_of(system, target) == "parquet":
                return spark.read.parquet(candidate)
            reader = spark.read.options(**CSV, multiLine=True)
            return (reader.schema(schema) if schema else reader).csv(candidate)
    raise FileNotFoundError(path)


def read_panel(spark: SparkSession, path: str, area: str = "area", ts: str = "hour_ts") -> DataFrame:
    """Panel with a naive timestamp and a normalised area."""
    df = read_any(spark, path)
    return df.withColumns({ts: F.col(ts).cast("timestamp_ntz"), area: area_code(F.col(area).cast("string"))})


DEGREES, METRES = "EPSG:4326", "EPSG:3857"


def read_polygons(spark: SparkSession, path: str, names: tuple[str, ...], where: str | None = None,
                  crs: str = DEGREES) -> DataFrame:
    """Polygon table with rings in degrees; the first existing name column becomes ``name``.

    ``crs`` says what the rings are stored in; a text column ``crs`` of the table says so row by row, where it is not null.
    Web Mercator metres are turned into degrees, another system gives null rings if a row names it and an error as parameter.
    """
    if crs not in (DEGREES, METRES):
        raise ValueError(f"unknown reference system {crs!r}")
    df = spark.read.parquet(path)
    label = next((c for c in names if c in df.columns), df.columns[0])
    kept = df.where(where) if where else df
    named = F.upper(F.coalesce(F.col("crs"), F.lit(crs))) if "crs" in df.columns else F.lit(crs)
    turned = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(
        geo.longitude_of(p["x"]).alias("x"), geo.latitude_of(p["y"]).alias("y"))))
    rings = F.when(named == DEGREES, F.col("rings")).when(named == METRES, turned)
    return kept.select("poly_id", F.col(label).cast("string").alias("name"), rings.alias("rings"))


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Parquet, Snappy by default; rows of one output folder are gathered, a large folder's by several tasks."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_dense_panel(df: DataFrame, path: str, area: str = "area", ts: str = "hour_ts") -> None:
    """Dense panel with one folder per area, written in parallel by area and month."""
    months = df.withColumn("_month", F.date_trunc("month", ts))
    months.repartition(area, "_month").drop("_month").sortWithinPartitions(area, ts) \
        .write.mode("overwrite").partitionBy(area).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV).csv(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Add rows to a running leaderboard table."""
    df.write.mode("append").parquet(path)


def merge_metrics(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Add rows to a running leaderboard so that the same run written twice counts once.

    Stored rows whose ``keys`` (null equals null) come again are replaced, others stay. The new table is written beside the
    old one and takes its place by two renames; if that is cut short, the old one stands under ``<path>.old``.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    here, new, old = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", f".{uuid.uuid4().hex}", ".old"))
    system = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(here) and system.exists(old):
        system.rename(old, here)
    rows = df
    if system.exists(here):
        stored = spark.read.parquet(here.toString())
        again = df.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
        rows = stored.join(again, same, "left_anti").unionByName(df, allowMissingColumns=True)
    rows.write.parquet(new.toString())
    if system.exists(here):
        system.delete(old, True)
        system.rename(here, old)
    system.rename(new, here)
    system.delete(old, True)


STORED_BY = ("dataset", "model")


def store_predictions(df: DataFrame, path: str) -> None:
    """Predictions in one folder per (dataset, model); only the folders that ``df`` has rows for are replaced."""
    df.hint("rebalance", *STORED_BY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*STORED_BY).parquet(path)


def stored_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions; a selection of data set and model reads their folders only."""
    found = spark.read.parquet(path).schema
    # names of models stay texts, whatever they look like
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in STORED_BY else f for f in found])
    return spark.read.schema(schema).parquet(path)


def read_cv_metrics(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """All ``<model>_cv_metrics.csv`` of a folder with the model from the file name."""
    raw = spark.read.schema(schema).options(**CSV).csv(f"{folder.rstrip('/')}/*_cv_metrics.csv")
    return raw.withColumn("model", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_cv_metrics\.csv$", 1))


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows and columns per input file."""
    return (
        df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("columns", F.lit(len(df.columns)))
    )


def tree_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``file, rows, columns`` of every Parquet and CSV file below ``folder``, also of those without rows.

    Rows are counted by one scan per format and header; columns are those of a file's own footer or header line.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed, found = {"parquet": [], "csv": []}, system.listFiles(path, True)
    while found.hasNext():
        at = found.next().getPath()
        if (kind := at.getName().rsplit(".", 1)[-1]) in listed:
            listed[kind].append((at.toString(), at.toUri().toString()))
    own = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    named = {re.sub("^file:/+", "file:/", uri): name for files in listed.values() for name, uri in files}
    columns = {uri: 0 for uri in named}
    parts = []
    if listed["parquet"]:
        widths = each([name for name, _ in listed["parquet"]],
                      lambda f: len(spark.read.option("recursiveFileLookup", True).parquet(f).columns))
        columns |= {re.sub("^file:/+", "file:/", uri): widths[name] for name, uri in listed["parquet"]}
        parts.append(spark.read.schema(T.StructType()).parquet(*[name for name, _ in listed["parquet"]]).select(own.alias("file")))
    if listed["csv"]:
        uris = dict(listed["csv"])
        for files in csv_headers(spark, list(uris)).values():
            members = [re.sub("^file:/+", "file:/", uris[f]) for f in files]
            header = spark.read.options(**CSV).csv(named[members[0]]).columns
            columns |= dict.fromkeys(members, len(header))
            schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
            parts.append(spark.read.schema(schema).options(**CSV, multiLine=True).csv([named[m] for m in members]).select(own.alias("file")))
    kept = spark.createDataFrame([(uri, named[uri], n) for uri, n in columns.items()], "uri string, name string, columns int")
    if not parts:
        return kept.select(F.col("name").alias("file"), F.lit(0).cast("long").alias("rows"), "columns")
    rows = reduce(DataFrame.unionByName, parts).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    return kept.join(rows, kept["uri"] == rows["file"], "left").select(
        F.col("name").alias("file"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "columns")
