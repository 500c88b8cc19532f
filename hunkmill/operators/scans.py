"""Queries that go through files: JSON lines, forge pages, tensors, tokenizers, sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import schemas, workspace
from hunkmill.operators import curation
from hunkmill.registry import query
from hunkmill.sources import forge, jsonl, models
from hunkmill.workspace import load

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
FIELDS = [f.name for f in schemas.REVIEW_COMMENT.fields]


@query("select id, in_reply_to_id, path, user.login as login, updated_at from review_comments")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments written as JSON lines and read again, strictly."""
    path = workspace.scratch_path(spark, "jsonl")
    jsonl.overwrite(load(spark, sf_dir, "review_comments").select(*FIELDS), path)
    rows = jsonl.scan(spark, [path], schemas.REVIEW_COMMENT)
    return rows.select("id", "in_reply_to_id", "path", F.col("user.login").alias("login"), "updated_at")


@query("""select count(*) as good, (select count(*) from chat_records) as bad from review_comments""")
def jsonl_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments, and beside them a line without an end, a bare text, a list or a value of another type per chat record: counted and skipped."""
    path = workspace.scratch_path(spark, "lenient")
    rows = load(spark, sf_dir, "review_comments")
    good = rows.select(F.to_json(F.struct(*FIELDS)).alias("value"))
    kinds = F.array(*map(F.lit, ('{"id": 1, "body": ', "no JSON", '[{"id": 1}]', '{"id": "seven", "body": "x"}')))
    bad = load(spark, sf_dir, "chat_records").select(F.element_at(kinds, (F.pmod("record_id", F.lit(4)) + 1).cast("int")).alias("value"))
    good.unionByName(bad).unionByName(good.limit(1).select(F.lit("  ").alias("value"))).write.text(path)
    return jsonl.skipped(jsonl.scan(spark, [path], schemas.REVIEW_COMMENT, strict=False))


@query("select finding_id, session_id, human.verdict as human, machine.verdict as machine from critic_findings")
def findings_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store replaced twice, atomically, and read strictly."""
    path = workspace.scratch_path(spark, "store")
    rows = load(spark, sf_dir, "critic_findings")
    jsonl.replace_atomically(rows.limit(1), path)
    jsonl.replace_atomically(rows, path)
    back = jsonl.scan(spark, [path], schemas.FINDING)
    return back.select("finding_id", "session_id", F.col("human.verdict").alias("human"), F.col("machine.verdict").alias("machine"))


def utc_text(stamp: str) -> Column:
    """An RFC 3339 text in the forge's form, UTC and without an empty fraction, in any session; other texts stay."""
    micros = F.unix_micros(F.try_to_timestamp(F.col(stamp)))
    local = F.timestamp_add("MICROSECOND", micros, F.expr("timestamp_ntz'1970-01-01 00:00:00'")).cast("string")
    return F.coalesce(F.concat(F.replace(local, F.lit(" "), F.lit("T")), F.lit("Z")), stamp)


def forge_pages(rows: DataFrame, size: int = 500) -> str:
    """Pages of all given comments, written by the tasks; the folder's path.

    ``updated_at`` is written as the forge does, in UTC; pages are ranges of it, rows without a time come first.
    Rows are shuffled once, by ranges; each task cuts its range into pages of ``size`` rows, the last one
    smaller, and holds one page at a time.  The index, one row per page, is written by the driver.
    """
    spark = rows.sparkSession
    folder = workspace.scratch_path(spark, "pages")
    ordered = rows.withColumn("updated_at", utc_text("updated_at")).repartitionByRange("updated_at", "delivery_id").sortWithinPartitions("updated_at", "delivery_id")
    slim = ordered.select("updated_at", F.to_json(F.struct(*FIELDS)).alias("row"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, task = forge.Folder(folder), TaskContext.get().partitionId()  # type: ignore[union-attr]
        page: list[tuple[str, str]] = []
        made: list[tuple[str, str, str]] = []

        def flush() -> None:
            name = f"page-{task:06d}-{len(made):06d}.json"
            target.write(name, ("[" + ",".join(row for _, row in page) + "]").encode())
            made.append((name, page[0][0], page[-1][0]))
            page.clear()

        for batch in batches:
            for at, row in zip(*(batch.column(c).to_pylist() for c in ("updated_at", "row")), strict=True):
                page.append((at or "", row))
                if len(page) == size:
                    flush()
        if page:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.string()) for k in range(3)], names=["name", "first", "last"])

    index = slim.mapInArrow(write, "name string, first string, last string").collect()
    forge.Folder(folder).write("index.json", json.dumps({"pages": sorted(list(r) for r in index)}).encode())
    return folder


#: DuckDB's form of :func:`utc_text`.
STAMP_SQL = "coalesce(replace((try_cast(trim(updated_at) as timestamptz) at time zone 'UTC')::varchar, ' ', 'T') || 'Z', updated_at)"


@query(f"select id, {STAMP_SQL} as updated_at from review_comments where {STAMP_SQL} >= '2023-01-01T00:00:00Z' and {STAMP_SQL} < '2025-01-01T00:00:00Z'")
def forge_windowed_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comments as pages; four windows of time, one task each, with the upper bound pushed into the scan."""
    forge.register(spark)
    pages = forge_pages(load(spark, sf_dir, "review_comments"))
    reader = spark.read.format("forge_comments").option("pages", pages).option("since", "2023-01-01T00:00:00Z").option("workers", 4)
    return reader.load().where("updated_at < '2025-01-01T00:00:00Z'").select("id", "updated_at")


@query(f"select count(distinct id) as ids, max({STAMP_SQL}) as mark from review_comments")
def forge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comments as pages, streamed into the shared folder in several batches; rows at a mark come twice and are told apart by identifier."""
    forge.register(spark)
    pages = forge_pages(load(spark, sf_dir, "review_comments"), 2000)
    per_batch = max(4, len(forge.Pages(pages).index) // 4)
    out, check = workspace.scratch_path(spark, "crawl"), workspace.scratch_path(spark, "crawl-check")
    stream = spark.readStream.format("forge_comments").option("pages", pages).option("pages_per_batch", per_batch).load()
    q = stream.writeStream.format("parquet").option("checkpointLocation", check).start(out)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    back = spark.read.schema(schemas.REVIEW_COMMENT).parquet(out)
    return back.agg(F.countDistinct("id").alias("ids"), F.max("updated_at").alias("mark"))


@query(
    f"""with c as (select {STAMP_SQL} as stamp from review_comments where {STAMP_SQL} < '2025-01-01T00:00:00Z'),
    m as (select max(stamp) as mark from c) select mark as checkpoint, count(*) as again from c, m where stamp >= mark group by mark"""
)
def crawl_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl that ended at a checkpoint, and how many of its rows a second one from there on would read again."""
    forge.register(spark)
    pages = forge_pages(load(spark, sf_dir, "review_comments"))
    reader = spark.read.format("forge_comments").option("pages", pages).option("until", "2025-01-01T00:00:00Z").option("workers", 4)
    path = workspace.scratch_path(spark, "resume") + "/comments.jsonl"
    forge.save_checkpoint(path, reader.load().agg(F.max("updated_at").alias("m")).first().m)
    since = forge.resume_mark(None, path)
    return reader.option("since", since).load().agg(F.lit(since).alias("checkpoint"), F.count("*").alias("again"))


@query()
def tokenized_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the bodies by a tokenizer file; null bodies have none."""
    rows = load(spark, sf_dir, "review_comments").where("body is not null")
    return rows.select("delivery_id", F.size(models.tokenizer_columns(F.col("body"), TOKENIZER)).alias("tokens"))


@query("select 'model.layers.' || label || '.self_attn.q_proj.weight' as name, 64::bigint as w, 8::bigint as a, 8::bigint as b, label % 2 = 0 as adapted from embeddings group by label")
def tensor_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weight for each label of the vectors in two shards, an adapter for every second one; scanned by prefix and paired."""
    labels = [r.label for r in load(spark, sf_dir, "embeddings").select("label").distinct().collect()]  # classes, few by nature
    rng = np.random.default_rng(0)
    folder, names = workspace.scratch_path(spark, "tensors"), {k: f"model.layers.{k}.self_attn.q_proj.weight" for k in labels}
    for part in (0, 1):
        some = {n: rng.normal(size=(8, 8)) for k, n in names.items() if k % 2 == part}
        forge.Folder(folder).write(f"{part}.safetensors", models.write_tensors(some | {f"lm_head.{part}": rng.normal(size=(50, 8))}))
    adapters = {n: (rng.normal(size=(1, 8)), rng.normal(size=(8, 1))) for k, n in names.items() if k % 2 == 0}
    models.save_adapter(f"{folder}/adapter", adapters, "base", 2.0)
    weights = models.scan_tensors(spark, folder, "model.").select("name", "tensor")
    pairs = models.pair_adapters(weights, models.scan_tensors(spark, f"{folder}/adapter", "base_model.").select("name", "tensor"))
    sizes = pairs.select("name", F.size("a").alias("a"), F.size("b").alias("b"))
    eight = F.lit(8).cast("bigint")
    joined = weights.select("name", F.size("tensor").cast("bigint").alias("w")).join(sizes, "name", "left")
    return joined.select("name", "w", F.coalesce(F.col("a").cast("bigint"), eight).alias("a"), F.coalesce(F.col("b").cast("bigint"), eight).alias("b"), F.col("a").isNotNull().alias("adapted"))


@query(
    f"""with {curation.FUNNEL_CTE}, n as (select count(*) as seen, {", ".join(f"count(*) filter (where reason = '{r}') as {r}" for r in curation.REASONS)} from funnel)
    select counter, n::bigint as n from (unpivot n on * into name counter value n)"""
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel's counters, observed while the records are written."""
    from hunkmill.plans.pipelines import curate

    done = curate(load(spark, sf_dir, "review_comments"), 0.4)
    jsonl.overwrite(done.records, workspace.scratch_path(spark, "records"))
    counts = done.counts.get
    return spark.createDataFrame([(k, int(v or 0)) for k, v in counts.items()], "counter string, n bigint")
