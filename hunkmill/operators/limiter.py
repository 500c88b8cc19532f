"""The adaptive concurrency limit, as a fold over answers in their order.

A success with round-trip time r moves the limit to ``limit * clamp(least / r, 0.5, 1) + sqrt(limit)``, an
error to four fifths; both are clamped.  The least time seen so far never forgets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill.registry import query
from hunkmill.workspace import load

SHRINK = 0.8
FASTEST_EVER = 1e-6


class Kind(NamedTuple):
    """What the rule needs of numbers, or of columns."""

    constant: Callable[[float], Any]
    least: Callable[..., Any]
    greatest: Callable[..., Any]
    root: Callable[[Any], Any]
    choose: Callable[[Any, Any, Any], Any]


NUMBERS = Kind(float, min, max, math.sqrt, lambda condition, yes, no: yes if condition else no)
COLUMNS = Kind(F.lit, F.least, F.greatest, F.sqrt, lambda condition, yes, no: F.when(condition, yes).otherwise(no))


def moved(limit: Any, fastest: Any, seconds: Any, ok: Any, bounds: tuple[float, float], kind: Kind) -> tuple[Any, Any]:
    """(limit, fastest) after one answer, whether these are numbers or columns."""
    low, high = map(kind.constant, bounds)
    took = kind.greatest(seconds, kind.constant(FASTEST_EVER))
    fastest = kind.choose(ok, kind.least(fastest, took), fastest)
    slower = kind.least(kind.greatest(fastest / took, kind.constant(0.5)), kind.constant(1.0))
    raw = kind.choose(ok, limit * slower + kind.root(limit), limit * SHRINK)
    return kind.least(kind.greatest(raw, low), high), fastest


def bounds_of(least: int, most: int) -> tuple[float, float]:
    low = float(max(least, 1))
    return low, max(float(most), low)


class Limiter:
    """The rule for use inside a task that calls a model."""

    def __init__(self, least: int = 1, most: int = 32, start: int = 2):
        self.bounds = bounds_of(least, most)
        self.limit_ = min(max(float(start), self.bounds[0]), self.bounds[1])
        self.fastest = math.inf

    @property
    def most(self) -> int:
        return int(self.bounds[1])

    @property
    def limit(self) -> int:
        return math.floor(self.limit_)

    def _take(self, seconds: float, ok: bool) -> None:
        self.limit_, self.fastest = moved(self.limit_, self.fastest, seconds, ok, self.bounds, NUMBERS)

    def success(self, seconds: float) -> None:
        self._take(seconds, True)

    def error(self) -> None:
        self._take(FASTEST_EVER, False)


def started(bounds: tuple[float, float], start: int) -> Column:
    return F.struct(F.lit(min(max(float(start), bounds[0]), bounds[1])).alias("limit"), F.lit(math.inf).alias("fastest"))


def fold(answers: Column, least: int = 1, most: int = 32, start: int = 2) -> Column:
    """struct(limit, fastest) after an ordered array of struct(rtt double, ok boolean)."""
    bounds = bounds_of(least, most)

    def step(s: Column, a: Column) -> Column:
        limit, fastest = moved(s["limit"], s["fastest"], a["rtt"], a["ok"], bounds, COLUMNS)
        return F.struct(limit.alias("limit"), fastest.alias("fastest"))

    return F.aggregate(answers, started(bounds, start), step)


def settled_limits(rows: DataFrame, by: str, order: list[str], rtt: Column, ok: Column) -> DataFrame:
    """(by, answers, limit): where each controller's limit stands after all its answers in order.

    A controller's answers are a sequence by nature, so they are one task's work, but they pass through it sorted,
    a batch at a time, and are never gathered.
    """
    slim = rows.select(by, *order, rtt.cast("double").alias("rtt"), ok.alias("ok"))
    kind = slim.schema[by].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, limiter, answers = None, Limiter(1, 32, 2), 0
        names, schema = [by, "answers", "limit"], None
        for batch in batches:
            done: list[tuple] = []
            schema = batch.schema.field(by).type
            for k, seconds, good in zip(*(batch.column(c).to_pylist() for c in (by, "rtt", "ok")), strict=True):
                if answers and k != key:
                    done.append((key, answers, limiter.limit))
                    limiter, answers = Limiter(1, 32, 2), 0
                key = k
                answers += 1
                limiter.success(seconds) if good else limiter.error()
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((schema, pa.int32(), pa.int64()))], names=names)
        if answers:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((key, schema), (answers, pa.int32()), (limiter.limit, pa.int64()))], names=names)

    return slim.repartition(by).sortWithinPartitions(by, *order).mapInArrow(run, f"{by} {kind}, answers int, limit bigint")


FOLD_SQL = """with recursive a as (select user_id, row_number() over (partition by user_id order by ts, event_id) as k, count(*) over (partition by user_id) as n,
      greatest(abs(value) / 1000, 1e-6) as rtt, event_type <> 'error' as ok from events),
    f as (select user_id, 0::bigint as k, 2::double as lim, 'infinity'::double as fastest from (select distinct user_id from events)
      union all select f.user_id, a.k, least(greatest(case when ok then lim * least(greatest(least(fastest, rtt) / rtt, 0.5), 1) + sqrt(lim) else lim * 0.8 end, 1), 32),
        case when ok then least(fastest, rtt) else fastest end from f join a on a.user_id = f.user_id and a.k = f.k + 1)
    select f.user_id, n::integer as answers, floor(lim)::bigint as limit from f join (select distinct user_id, n from a) using (user_id) where k = n"""


@query(FOLD_SQL)
def limiter_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One controller per user of the event table; values stand in for milliseconds."""
    rows = load(spark, sf_dir, "events")
    return settled_limits(rows, "user_id", ["ts", "event_id"], F.abs("value") / 1000, F.col("event_type") != "error")


@query(
    """with recursive f as (select 0 as k, 2::double as lim, 'infinity'::double as fastest union all
      select k + 1, least(greatest(lim * least(greatest(least(fastest, rtt) / rtt, 0.5), 1) + sqrt(lim), 1), 32), least(fastest, rtt)
      from (select *, 0.05::double * greatest(floor(lim) / 8.0::double, 1) as rtt from f) where k < 800)
    select floor(lim)::bigint as limit from f where k = 800"""
)
def limiter_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controller against a model server whose times grow beyond eight requests in flight."""
    def step(s: Column, _: Column) -> Column:
        rtt = F.lit(0.05) * F.greatest(F.floor(s["limit"]) / 8.0, F.lit(1.0))
        limit, fastest = moved(s["limit"], s["fastest"], rtt, F.lit(True), bounds_of(1, 32), COLUMNS)
        return F.struct(limit.alias("limit"), fastest.alias("fastest"))

    rounds = spark.range(1).select(F.sequence(F.lit(1), F.lit(800)).alias("rounds"))
    return rounds.select(F.floor(F.aggregate("rounds", started(bounds_of(1, 32), 2), step)["limit"]).alias("limit"))
