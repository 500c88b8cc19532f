"""Keeping one copy of messages that arrive at least once.

:class:`DeliveryLedger` is the incremental operator: an identifier index says in which
historical partitions the incoming identifiers already live, only those partitions are
read, winners are recomputed from old and new rows together, and the touched partitions
are replaced in one atomic step.  :func:`latest_deliveries` is the one-shot form.

Defined results:

* A row with a null identifier is nobody's copy: it always stays.
* The latest ``updated_at`` wins, read as an instant.  A null or unreadable time loses
  against every readable one.  Of equal instants the smallest delivery number stays.
* Rows repeated in full, under the same delivery number, count as one row.
* Empty batches change nothing.  Columns beyond the three that are named are ignored, so
  names that clash with the ledger's own do no harm.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hunkmill import workspace

SLIM = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("id", "delivery_id", "at_us")] + [T.StructField("home", T.IntegerType())]
)
INDEX = T.StructType([T.StructField("id", T.LongType()), T.StructField("home", T.IntegerType())])
REMOVED = T.StructType([T.StructField("id", T.LongType()), T.StructField("delivery_id", T.LongType())])


def instant_us(stamp: Column) -> Column:
    """Microseconds since the epoch of an RFC 3339 text; null where it can't be read."""
    return F.unix_micros(F.trim(stamp).try_cast("timestamp"))


def preference(at_us: Column, delivery_id: Column) -> Column:
    """A struct whose maximum marks the delivery that stays."""
    return F.struct(F.coalesce(at_us, F.lit(-(2**63))).alias("at_us"), (-delivery_id).alias("order"))


def latest_deliveries(
    deliveries: DataFrame, key: str = "id", stamp: str = "updated_at", order: str = "delivery_id"
) -> DataFrame:
    """(key, order) of the delivery that stays, one row per non-null key.

    One hash aggregation with a map-side combine, so a key that holds a third of all rows
    reaches its reducer as one row per map task.
    """
    best = F.max(preference(instant_us(F.col(stamp)), F.col(order))).alias("_best")
    won = deliveries.where(F.col(key).isNotNull()).groupBy(key).agg(best)
    return won.select(key, (-F.col("_best.order")).alias(order))


def keep_latest(deliveries: DataFrame, key: str = "id", stamp: str = "updated_at", order: str = "delivery_id") -> DataFrame:
    """The whole rows that stay, rows with a null key included.

    The delivery number is unique, so the join back has no hot key even if one identifier
    holds a third of all rows.
    """
    won = latest_deliveries(deliveries, key, stamp, order).select(F.col(order).alias("_kept_order"))
    kept = deliveries.join(won, F.col(order) == F.col("_kept_order"), "left_semi").dropDuplicates([order])
    return kept.unionByName(deliveries.where(F.col(key).isNull()))


class Conflict(RuntimeError):
    """Another writer published the version first."""


class DeliveryLedger:
    """The winners of all deliveries so far, in partitions by month of first arrival.

    On disk: versioned partition folders, an identifier index of (id, partition) in hash buckets, the removed
    deliveries, and one manifest per version that names the files of that version.  A commit writes new folders
    beside the old ones and then adds the next manifest, which fails if there is one of that version: the
    second of two writers reads the ledger again and repeats its merge.  A reader or a crashed writer never
    sees half a batch.

    A batch looks up its own buckets of the index only.  Index and removed deliveries are kept like a
    log-structured tree: ``FAN_IN`` folders of a level are merged into one of the next, so there are few
    of them after any number of commits; a partition of as many folders is rewritten with the next batch.

    Files of versions no manifest names any more are left to the folder's clean-up.  On file systems without an
    atomic rename or link two writers need a lock of their own.
    """

    BUCKETS = 32
    FAN_IN = 8
    ATTEMPTS = 10
    #: Manifests that stay for readers that have just looked them up.
    OLD_MANIFESTS = 20

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- manifest ---------------------------------------------------------------------

    def _path(self, name: str):
        """(file system, qualified path) of a file of the ledger; a root without a scheme is the default file system's."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs, fs.makeQualified(target)

    def _versions(self) -> list[int]:
        fs, folder = self._path("manifests")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self) -> dict:
        """The current manifest; that of an empty ledger if none was written yet."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "parts": {}, "index": [], "removed": []}
        fs, at = self._path(f"manifests/{versions[-1]:012d}.json")
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Add the manifest of a version, or raise :class:`Conflict` if that version is there."""
        jvm = self.spark._jvm
        fs, staged = self._path(f"manifests/{uuid.uuid4().hex}.tmp")
        out = fs.create(staged, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        _, target = self._path(f"manifests/{manifest['version']:012d}.json")
        try:
            if staged.toUri().getScheme() == "file":  # whose rename checks first and moves then
                jvm.java.nio.file.Files.createLink(jvm.java.io.File(target.toUri()).toPath(), jvm.java.io.File(staged.toUri()).toPath())
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(staged, target, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(str(manifest["version"])) from e
            raise
        finally:
            fs.delete(staged, False)
        for version in self._versions()[: -self.OLD_MANIFESTS]:
            fs.delete(self._path(f"manifests/{version:012d}.json")[1], False)

    # -- reads ------------------------------------------------------------------------

    def _read(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def winners(self) -> DataFrame:
        """(id, delivery_id, at_us, home) of every delivery that stays."""
        return self._read([p for folders in self.manifest()["parts"].values() for p in folders], SLIM)

    def removed(self) -> DataFrame:
        """(id, delivery_id) of every delivery that lost, over all commits."""
        return self._read([x["path"] for x in self.manifest()["removed"]], REMOVED).distinct()

    def _lookup(self, index: list[dict], incoming: DataFrame) -> list[int]:
        """The partitions that hold incoming identifiers, from their buckets of the index."""
        if not index:
            return []
        buckets = {r.bucket for r in incoming.select(_bucket(self.BUCKETS).alias("bucket")).distinct().collect()}  # BUCKETS numbers at most
        paths = [f"{x['path']}/bucket={b}" for x in index for b in x["buckets"] if b in buckets]
        hit = self._read(paths, INDEX).join(incoming.select("id").distinct(), "id", "left_semi").select("home").distinct()
        return sorted(r.home for r in hit.collect())

    # -- the operator -----------------------------------------------------------------

    def ingest(self, batch: DataFrame, key: str, order: str, stamp: str, arrived: str) -> list[int]:
        """Merge a batch of deliveries; returns the historical partitions it rewrote.

        The only rows that reach the driver are numbers of partitions, one per month, and of buckets.
        """
        month = F.coalesce(F.year(arrived) * 12 + F.month(arrived) - 1, F.lit(0)).cast("int")
        incoming = workspace.keep(
            batch.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("id"), F.col(order).alias("delivery_id"))
            .agg(F.max(instant_us(F.col(stamp))).alias("at_us"), F.min(month).alias("home")),
            "incoming",
        )
        try:
            for _ in range(self.ATTEMPTS):
                try:
                    return self._merge(incoming)
                except Conflict:
                    continue
            raise Conflict(f"{self.ATTEMPTS} attempts to publish failed")
        finally:
            workspace.forget(incoming)

    def _merge(self, incoming: DataFrame) -> list[int]:
        now = self.manifest()
        touched = self._lookup(now["index"], incoming)
        full = [int(p) for p, folders in now["parts"].items() if len(folders) >= self.FAN_IN]
        history = self._read([f for t in {*touched, *full} for f in now["parts"][str(t)]], SLIM)

        rows = history.withColumn("new", F.lit(0)).unionByName(incoming.withColumn("new", F.lit(1)))
        won = workspace.keep(
            rows.groupBy("id")
            .agg(
                F.max(preference(F.col("at_us"), F.col("delivery_id"))).alias("best"),
                F.min(F.struct("new", "home")).alias("place"),
            )
            .select("id", (-F.col("best.order")).alias("delivery_id"), "best.at_us", "place.home", "place.new"),
            "winners",
        )
        version = now["version"] + 1
        data = f"v{version}-{uuid.uuid4().hex[:8]}"
        won.drop("new").withColumn("part", F.col("home")).hint("rebalance", "part").write.partitionBy("part").parquet(
            f"{self.root}/{data}/parts"
        )
        losers = rows.select("id", "delivery_id").join(won.select("delivery_id"), "delivery_id", "left_anti")
        index = self._grown(now["index"], won.where("new = 1").select("id", "home"), INDEX, f"{data}/index", bucketed=True)
        removed = self._grown(now["removed"], losers.select("id", "delivery_id"), REMOVED, f"{data}/removed")

        parts = {p: folders for p, folders in now["parts"].items() if int(p) not in {*touched, *full}}
        for r in won.select("home").distinct().collect():
            parts[str(r.home)] = [*parts.get(str(r.home), []), f"{data}/parts/part={r.home}"]
        workspace.forget(won)
        try:
            self._publish({"version": version, "parts": parts, "index": index, "removed": removed})
        except Conflict:
            workspace.drop_path(self.spark, f"{self.root}/{data}")
            raise
        return touched

    def _grown(self, entries: list[dict], rows: DataFrame, schema: T.StructType, path: str, bucketed: bool = False) -> list[dict]:
        """The entries and one with the rows; those of a level that is full go into it, and it to the next level."""
        level, merged = 0, []
        while len(same := [x for x in entries if x["level"] == level]) >= self.FAN_IN - 1:
            merged += same
            entries = [x for x in entries if x["level"] != level]
            level += 1
        if merged:
            old = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{self.root}/{x['path']}" for x in merged])
            rows = rows.unionByName(old).distinct()
        entry: dict = {"level": level, "path": path}
        if bucketed:
            rows = rows.withColumn("bucket", _bucket(self.BUCKETS))
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{path}")
            fs, folder = self._path(path)
            names = [f.getPath().getName() for f in fs.listStatus(folder)]
            entry["buckets"] = sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))
        else:
            rows.write.parquet(f"{self.root}/{path}")
        return [*entries, entry]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
