"""Where tables are read from, and where intermediate tables are kept.

Iterative operators cut their lineage by writing a Parquet table into the folder that
the cluster shares (``spark.checkpoint.dir``).  Such a table survives the loss of any
executor, is columnar and compressed, and its row count costs only a footer read.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: The session's setting by which a query's shuffle files are removed at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the data directory ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share.

    Taken from ``spark.checkpoint.dir``; only a local master without that setting gets
    a temporary folder, since there driver and executors are one process.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _OWN:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="hunkmill-")
        atexit.register(_forget, _OWN[app].removeprefix("file://"))
    return _OWN[app]


def _forget(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; ``label`` only helps a human reading it.

    The application's part of the folder is deleted when the driver's interpreter ends; tables that an
    iteration no longer needs go earlier, by :func:`forget`.
    """
    own = f"{shared_root(spark)}/hunkmill/{spark.sparkContext.applicationId}"
    if own not in _SCRATCH:
        _SCRATCH.add(own)
        atexit.register(_drop_at_end, spark, own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


_SCRATCH: set[str] = set()


def _drop_at_end(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the JVM may have ended first; the folder then stays
        pass


def spread(df: DataFrame) -> DataFrame:
    """In as many partitions as there are cores, if it has fewer: one small file is one task otherwise.

    Inputs with more splits than cores, and so all large ones, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def where_once(df: DataFrame, condition: Column) -> DataFrame:
    """As ``where``, for conditions made of costly columns.

    A plain filter would be pushed below the projections that make those columns, and make them twice.
    """
    return df.select(F.explode(F.when(condition, F.array(F.struct("*")))).alias("r")).select("r.*")


def keep(df: DataFrame, label: str, partitions: int | None = None, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it back.

    The result has no lineage to the inputs.  ``partitions`` only merges tasks.  ``tidy`` removes the write's
    shuffle files when it is over; else they stay until the driver happens to collect its garbage.
    """
    path, conf = scratch_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(TIDY, None)
    if tidy:
        conf.set(TIDY, "true")
    try:
        (df.coalesce(partitions) if partitions else df).write.parquet(path)
    finally:
        if tidy:
            conf.unset(TIDY) if before is None else conf.set(TIDY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path on whatever file system holds it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that ``keep`` returned and nobody reads any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make ``import hunkmill`` work in the executors' Python workers.

    The package is zipped once per application and sent with ``addPyFile``; on a local
    master the workers see the driver's files anyway.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="hunkmill-zip-"), "hunkmill.zip")
    atexit.register(_forget, os.path.dirname(target))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith((".py", ".json", ".txt")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(target)
