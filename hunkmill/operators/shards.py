"""Time shards of a crawl: equal windows, half-open intervals, weighted windows, the high-water mark.

Rows without a time belong to no shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill.registry import query
from hunkmill.workspace import load

SHARDS = 8


def windows(start: int, end: int, n: int) -> list[tuple[int, int]]:
    """[start, end) in seconds as ``n`` equal half-open windows; the last takes the remainder.

    With more windows than seconds the surplus ones would lie past the end; they are empty here.
    """
    step = max((end - start) // n, 1)
    return [(min(start + i * step, end), end if i == n - 1 else min(start + (i + 1) * step, end)) for i in range(n)]


def shard_of(seconds: Column, start: int, end: int, n: int) -> Column:
    """The number of the window that holds a time; null outside [start, end)."""
    step = max((end - start) // n, 1)
    number = F.least(F.floor((seconds - start) / step), F.lit(n - 1))
    return F.when((seconds >= start) & (seconds < end), number)


def in_window(stamp: Column, since: str | None, until: str | None) -> Column:
    """RFC 3339 texts of one form, compared as texts: from ``since`` on, before ``until``."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (stamp >= since)
    return cond & (stamp < until) if until is not None else cond


def high_water(rows: DataFrame, stamp: str, since: str | None = None) -> DataFrame:
    """(mark): the largest stamp, at least the previous mark."""
    return rows.agg(F.max(stamp).alias("top")).select(F.greatest("top", F.lit(since)).alias("mark"))


def weighted_shards(rows: DataFrame, seconds: str, n: int, grain: int = 86_400) -> DataFrame:
    """(shard, start, end, n): windows of about equally many rows, at whole grains of time.

    Rows are counted per grain first; only those counts are added up in order, and their number depends
    on the time spanned, not on the rows.
    """
    per = rows.where(F.col(seconds).isNotNull()).groupBy((F.floor(F.col(seconds) / grain) * grain).alias("at")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    before = F.coalesce(F.sum("n").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = per.select("at", "n", F.least(F.floor(before * n / total), F.lit(n - 1)).alias("shard"))
    return placed.groupBy("shard").agg(F.min("at").alias("start"), (F.max("at") + grain).alias("end"), F.sum("n").alias("n"))


def _seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events")
    return rows.select("event_id", F.col("ts").cast("timestamp_ntz").cast("timestamp").cast("bigint").alias("at"))


BOUNDS_SQL = "b as (select min(epoch(ts)::bigint) as s, max(epoch(ts)::bigint) + 1 as e from events)"
SHARD_SQL = f"least((floor(epoch(ts)) - s)::bigint // greatest((e - s) // {SHARDS}, 1), {SHARDS - 1})"


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _seconds(spark, sf_dir)
    bounds = rows.agg(F.min("at").alias("s"), (F.max("at") + 1).alias("e")).first()
    return rows.withColumn("shard", shard_of(F.col("at"), bounds.s or 0, bounds.e or 1, SHARDS))


@query(f"with {BOUNDS_SQL} select event_id, {SHARD_SQL} as shard from events, b")
def time_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharded(spark, sf_dir).select("event_id", "shard")


@query(f"with {BOUNDS_SQL} select {SHARD_SQL} as shard, count(*) as n from events, b group by rollup(1)")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharded(spark, sf_dir).rollup("shard").agg(F.count("*").alias("n"))


@query("select delivery_id from review_comments where created_at >= '2023-01-01T00:00:00Z' and created_at < '2024-01-01T00:00:00Z'")
def half_open_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "review_comments")
    return rows.where(in_window(F.col("created_at"), "2023-01-01T00:00:00Z", "2024-01-01T00:00:00Z")).select("delivery_id")


@query("select greatest(max(created_at), '2020-01-01T00:00:00Z') as mark from review_comments")
def checkpoint_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water(load(spark, sf_dir, "review_comments"), "created_at", "2020-01-01T00:00:00Z")


@query(
    f"""with per as (select epoch(ts)::bigint // 86400 * 86400 as t, count(*) as n from (select date_trunc('second', ts) as ts from events) group by 1),
    placed as (select t, n, least((coalesce(sum(n) over (order by t rows between unbounded preceding and 1 preceding), 0) * {SHARDS}) // (sum(n) over ()), {SHARDS - 1})::bigint as shard from per)
    select shard, min(t) as start, max(t) + 86400 as "end", sum(n)::bigint as n from placed group by 1"""
)
def weighted_time_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_shards(_seconds(spark, sf_dir), "at", SHARDS)


@query(
    """select delivery_id, epoch_us(cast(updated_at as timestamptz)) // 1000000 as at,
    strftime(cast(updated_at as timestamptz) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as utc from review_comments"""
)
def rfc3339_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.trim("updated_at").try_cast("timestamp")
    rows = load(spark, sf_dir, "review_comments")
    return rows.select("delivery_id", F.unix_seconds(at).alias("at"), F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"))


@query(
    """with a as (select * from review_comments where delivery_id % 2 = 0 or delivery_id % 3 = 0), b as (select * from review_comments where delivery_id % 2 = 1 or delivery_id % 3 = 0)
    select count(*) as n, count(distinct delivery_id) as deliveries from (select * from a union all select * from b)"""
)
def union_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards that overlap, one behind the other; what overlaps is told apart later."""
    rows = load(spark, sf_dir, "review_comments")
    a, b = rows.where("delivery_id % 2 = 0 or delivery_id % 3 = 0"), rows.where("delivery_id % 2 = 1 or delivery_id % 3 = 0")
    return a.unionByName(b).agg(F.count("*").alias("n"), F.countDistinct("delivery_id").alias("deliveries"))
