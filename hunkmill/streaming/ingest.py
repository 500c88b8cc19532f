"""Streams: checkpointed ingestion, deduplication in a watermark, idempotent merges, windows, live limits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hunkmill import workspace
from hunkmill.operators.deliveries import DeliveryLedger
from hunkmill.operators.limiter import FOLD_SQL, Limiter
from hunkmill.registry import query


#: Files that a table is cut into, and so micro-batches of the streams over it.
FILES = 4


def stream_table(spark: SparkSession, sf_dir: str, name: str, at: str, files_per_trigger: int = 1) -> DataFrame:
    """A table as a stream of files that hold later and later rows, one micro-batch each.

    The file source takes files by their time of change, which is set in the order of the ranges.
    """
    table = workspace.load(spark, sf_dir, name)
    path = workspace.scratch_path(spark, f"{name}-stream")
    table.repartitionByRange(FILES, at).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(f.getPath().toString() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    for k, file in enumerate(files):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(file), 1_700_000_000_000 + 1000 * k, -1)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_in_watermark(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Each key once, as long as its repeats come within the delay; older state is dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(stream: DataFrame, at: str, width: str, delay: str, *by: str) -> DataFrame:
    """Counts per window of event time, final once the watermark has passed."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width).alias("window"), *by).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, at: str, gap: str, delay: str, *by: str) -> DataFrame:
    """Counts per session of a key; a session ends after a gap without events."""
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("window"), *by).agg(F.count("*").alias("n"))


def into_ledger(stream: DataFrame, root: str, key: str, order: str, stamp: str, arrived: str):
    """A writer that merges every micro-batch into a delivery ledger.

    A batch that is run again after a crash finds its rows there already and changes nothing, so the merge
    is effectively once.
    """
    def merge(batch: DataFrame, _: int) -> None:
        DeliveryLedger(batch.sparkSession, root).ingest(batch, key, order, stamp, arrived)

    return stream.writeStream.foreachBatch(merge)


LIMITS = "user_id bigint, answers bigint, limit bigint"
LIMIT_STATE = "answers bigint, limit double, fastest double"


def live_limits(stream: DataFrame) -> DataFrame:
    """The controller's limit of each user (user_id, ts, event_id, rtt, ok) as answers arrive; its state is kept per user.

    Within a micro-batch answers are taken in the order of time and number.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        limiter = Limiter(1, 32, 2)
        answers = 0
        if state.exists:
            answers, limiter.limit_, limiter.fastest = state.get
        for row in pd.concat(list(frames)).sort_values(["ts", "event_id"]).itertuples():
            answers += 1
            if row.ok:
                limiter.success(row.rtt)
            else:
                limiter.error()
        state.update((answers, limiter.limit_, limiter.fastest))
        yield pd.DataFrame({"user_id": [key[0]], "answers": [answers], "limit": [limiter.limit]})

    return stream.groupBy("user_id").applyInPandasWithState(step, LIMITS, LIMIT_STATE, "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return its rows from the shared folder."""
    spark = stream.sparkSession
    out, check = workspace.scratch_path(spark, f"{name}-out"), workspace.scratch_path(spark, f"{name}-check")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(out)


@query("select distinct user_id, event_type, date_trunc('day', ts) as day from events")
def dedup_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair once a day; its repeats come within the delay, and the state of past days is dropped."""
    events = stream_table(spark, sf_dir, "events", "ts").withColumn("at", F.col("ts").cast("timestamp")).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return drain(first_in_watermark(events, ["user_id", "event_type", "day"], "at", "2 days"), "dedup").select("user_id", "event_type", "day")


@query("select date_trunc('day', ts) as day, event_type, count(*) as n from events group by 1, 2")
def tumbling_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In update mode every window's last state is its count."""
    events = stream_table(spark, sf_dir, "events", "ts").withColumn("at", F.col("ts").cast("timestamp"))
    states = drain(tumbling_counts(events, "at", "1 day", "1 day", "event_type"), "windows", "update")
    last = states.groupBy("window.start", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query(
    """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end as new from events),
    s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
    select user_id, min(ts) as start, count(*) as n from s group by user_id, k"""
)
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, in batch."""
    events = workspace.load(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    found = events.groupBy(F.session_window("at", "6 hours").alias("window"), "user_id").agg(F.count("*").alias("n"))
    return found.select("user_id", F.col("window.start").cast("timestamp_ntz").alias("start"), "n")


@query(
    """select id, delivery_id from (select id, delivery_id, row_number() over (partition by id order by cast(updated_at as timestamptz) desc nulls last, delivery_id) as place
    from review_comments where id is not null) where place = 1"""
)
def stream_into_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review comments streamed into a ledger; the winners."""
    root, check = workspace.scratch_path(spark, "live-ledger"), workspace.scratch_path(spark, "live-check")
    comments = stream_table(spark, sf_dir, "review_comments", "ingested_at").select("id", "delivery_id", "updated_at", "ingested_at")
    writer = into_ledger(comments, root, "id", "delivery_id", "updated_at", "ingested_at")
    writer.option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return DeliveryLedger(spark, root).winners().select("id", "delivery_id")


@query(FOLD_SQL.replace("n::integer", "n::bigint"))
def live_limiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming twin of ``limiter_fold``, over several micro-batches."""
    events = stream_table(spark, sf_dir, "events", "ts")
    answers = events.select("user_id", "ts", "event_id", (F.abs("value") / 1000).alias("rtt"), (F.col("event_type") != "error").alias("ok"))
    states = drain(live_limits(answers), "limits", "update")
    return states.groupBy("user_id").agg(F.max_by("answers", "batch").alias("answers"), F.max_by("limit", "batch").alias("limit"))
