"""The registered queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import registry, workspace
from hunkmill.operators import curation, diffs, evaluation, examples, findings, hybrid, limiter, rendering, scalars, scans, shards  # noqa: F401  they register their queries
from hunkmill.operators.deliveries import DeliveryLedger
from hunkmill.plans import pipelines  # noqa: F401
from hunkmill.streaming import ingest  # noqa: F401

#: Deliveries of this many last days of the crawl come to the ledger as the second batch.
INCOMING_DAYS = 30


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that must go: history and the last month pass through one ledger, in two batches."""
    rows = workspace.load(spark, sf_dir, "review_comments").select("id", "delivery_id", "updated_at", "ingested_at")
    cut = rows.agg((F.max("ingested_at") - F.expr(f"interval {INCOMING_DAYS} days")).alias("cut")).first().cut
    ledger = DeliveryLedger(spark, workspace.scratch_path(spark, "ledger"))
    late = F.col("ingested_at") > F.lit(cut) if cut is not None else F.lit(False)
    for batch in (rows.where(~F.coalesce(late, F.lit(False))), rows.where(late)):
        ledger.ingest(batch, key="id", order="delivery_id", stamp="updated_at", arrived="ingested_at")
    return ledger.removed()


P5_SQL = """
select id, delivery_id from (
  select id, delivery_id, row_number() over (
    partition by id order by cast(updated_at as timestamptz) desc nulls last, delivery_id) as place
  from review_comments where id is not null)
where place > 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**registry.QUERIES, "p5_found": p5_found}


def oracle_sql() -> dict[str, str]:
    return {**registry.SQL, "p5_found": P5_SQL}
