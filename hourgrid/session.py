"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times are naive local times, so the session zone must not move them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles a method of more bytecode: fused code of wide rows would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This session's folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are places that all executors reach. The folder goes when the session's JVM ends in order, or by
    ``cleanup``; a session that is killed leaves it behind.
    """
    context = spark.sparkContext
    parent = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{parent.rstrip('/')}/hourgrid-{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    if _CLEANED.get(context.applicationId) != folder:
        _CLEANED[context.applicationId] = folder
        system, path = _place(spark, folder)
        system.mkdirs(path)
        system.deleteOnExit(path)
    return folder


_CLEANED: dict[str, str] = {}


def _place(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def cleanup(spark: SparkSession) -> None:
    """Delete this session's intermediate tables; frames that still read them cannot be used any more."""
    folder = _CLEANED.pop(spark.sparkContext.applicationId, None)
    if folder:
        system, path = _place(spark, folder)
        system.delete(path, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and read it from there.

    This cuts the lineage, survives lost executors and, unlike a row checkpoint, lets
    later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
