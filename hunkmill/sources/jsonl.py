"""JSON lines in and out: strict and lenient scans with a stable order, atomic replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hunkmill import workspace


def scan(spark: SparkSession, paths: list[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """Rows of several files, with ``file_idx`` in the order given and ``offset`` rising within a file.

    Blank lines are skipped.  A line that is no JSON object aborts a strict scan; a lenient one keeps it
    with null fields and its text in ``_bad``.  ``(file_idx, offset)`` is the input order: the offset
    orders the lines of one file, whatever splits it was read in.
    """
    frames = []
    for k, path in enumerate(paths):
        lines = spark.read.text(current(spark, path))
        place = lines.select(
            F.lit(k).alias("file_idx"),
            F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("offset"),
            "value",
        )
        frames.append(place.where(F.trim("value") != ""))
    rows = reduce(DataFrame.unionByName, frames)
    typed = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    mode = "FAILFAST" if strict else "PERMISSIVE"
    options = {"mode": mode} if strict else {"mode": mode, "columnNameOfCorruptRecord": "_bad"}
    parsed = rows.withColumn("r", F.from_json("value", schema if strict else typed, options))
    return parsed.select("file_idx", "offset", "r.*")


def skipped(rows: DataFrame) -> DataFrame:
    """(good, bad) of a lenient scan."""
    return rows.agg(F.count_if(F.col("_bad").isNull()).alias("good"), F.count_if(F.col("_bad").isNotNull()).alias("bad"))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def current(spark: SparkSession, path: str) -> str:
    """Where the rows of a replaced table are: the path, or what was moved away if a writer ended between its two renames."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{path}.old" if not fs.exists(jpath(path)) and fs.exists(jpath(f"{path}.old")) else path


def replace_atomically(rows: DataFrame, path: str) -> None:
    """Write beside the target, then swap by two renames; :func:`current` finds the old rows or the new ones at any time.

    A writer that ends between the renames leaves the old rows where :func:`current` finds them, and the next
    one goes on from there.  On an object store without atomic renames use the ledger's manifests instead.
    """
    spark = rows.sparkSession
    staged, old = f"{path}.tmp", f"{path}.old"
    rows.write.mode("overwrite").json(staged)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jpath(path)):
        workspace.drop_path(spark, old)
        if not fs.rename(jpath(path), jpath(old)):
            raise OSError(f"can't move {path} away")
    if not fs.rename(jpath(staged), jpath(path)):
        raise OSError(f"can't move {staged} into place")
    workspace.drop_path(spark, old)
