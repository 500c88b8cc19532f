"""The end-to-end plans: curate raw comments, review the hunks of a diff, judge and label, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hunkmill.functions import text
from hunkmill.operators import critics, curation, diffs, findings, rendering
from hunkmill.registry import query
from hunkmill.sources import jsonl
from hunkmill.workspace import load


@dataclass
class Curated:
    records: DataFrame
    counts: Observation


def curate(comments: DataFrame, min_score: float = 0.0, min_len: int = 20) -> Curated:
    """Chat records, and the funnel's counters observed while the records are written."""
    rows = curation.funnel(comments, min_score, min_len)
    counts = Observation("funnel")
    seen = rows.observe(counts, F.count("*").alias("seen"), *[F.count_if(F.col("reason") == r).alias(r) for r in curation.REASONS])
    return Curated(curation.chat_records(seen), counts)


def curate_files(spark: SparkSession, paths: list[str], out: str, min_score: float = 0.0) -> dict[str, int]:
    """From JSON lines to JSON lines; returns the funnel's counters.

    Input order is that of the files and of the lines in them.
    """
    from hunkmill.operators.findings import number_rows
    from hunkmill.schemas import REVIEW_COMMENT

    rows = jsonl.scan(spark, paths, REVIEW_COMMENT)
    ordered = number_rows(rows.withColumn("place", F.struct("file_idx", "offset")), "place", "delivery_id")
    done = curate(ordered, min_score)
    jsonl.overwrite(done.records, out)
    return {k: int(v or 0) for k, v in done.counts.get.items()}


def prompts(hunks: DataFrame, repo: str, pr: int) -> DataFrame:
    """(path, hunk_header, hunk_raw, prompt) of the hunks (path, header, raw)."""
    user = text.user_prompt(F.lit(repo), F.lit(pr), F.col("path"), F.col("raw"))
    return hunks.select("path", F.col("header").alias("hunk_header"), F.col("raw").alias("hunk_raw"), user.alias("prompt"))


def hunks_of(diff: DataFrame) -> DataFrame:
    """(doc, f, h, path, header, raw) of diffs (doc, diff)."""
    lines = diffs.lines_of(diff, "doc", "diff")
    named = diffs.files(lines).select("doc", "f", "path")
    return diffs.hunks(lines).join(named, ["doc", "f"]).select("doc", "f", "h", "path", "header", "raw")


def review(diff: DataFrame, repo: str, pr: int, session: str, at: str, make: Callable[[], critics.Critic] | None = None) -> tuple[DataFrame, DataFrame]:
    """(fresh findings, calls): every hunk of a diff through a critic, the stub if none is given."""
    jobs = hunks_of(diff).withColumn("job", F.concat_ws(" ", "doc", "f", "h"))
    asked = jobs.withColumn("prompt", text.user_prompt(F.lit(repo), F.lit(pr), F.col("path"), F.col("raw")))
    base = asked.select("job", F.lit(repo).alias("repo"), F.lit(pr).cast("bigint").alias("pr"), "path", F.col("header").alias("hunk_header"), F.col("raw").alias("hunk_raw"), "prompt")
    none = F.lit(None)
    tail = {
        "session_id": F.lit(session), "created_at": F.lit(at),
        "human": none.cast("struct<verdict:string,is_design_problem:boolean,severity:string,note:string,judged_at:string,judged_by:string>"),
        "machine": none.cast("struct<verdict:string,reason:string,judged_at:string,judged_by:string>"),
    }
    if make is None:
        out = findings.stub_review(base, "prompt")
        return out.withColumns(tail), base.select(F.col("job").alias("key"), F.lit("ok").alias("status"))
    model = make().model_version
    calls = critics.review_hunks(base, "job", "prompt", make)
    said = base.join(calls.select(F.col("key").alias("job"), F.explode("comments").alias("critic_comment")), "job").drop("job")
    ids = findings.finding_id(F.lit(model), F.col("repo"), F.col("pr"), F.col("path"), F.col("hunk_header"), F.col("critic_comment"))
    made = {"finding_id": ids, "model_version": F.lit(model), "cited_line": none.cast("bigint"), "grounded": F.lit(True)}
    return said.withColumns(made | tail), calls.select("key", "status")


def trim_to(files: DataFrame, hunks: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files and hunks on which a kept finding stands: two left semi joins."""
    keys = kept.select("path", F.col("hunk_header").alias("header"))
    return files.join(kept.select("path"), "path", "left_semi"), hunks.join(keys, ["path", "header"], "left_semi")


def write_report(parts: DataFrame, path: str) -> None:
    """One HTML text per pull request, as rows of text files."""
    rendering.reports(parts).select("html").write.mode("overwrite").text(path)


def dump_prompts(hunks: DataFrame, repo: str, pr: int, path: str) -> None:
    rows = prompts(hunks, repo, pr)
    jsonl.overwrite(rows.select(F.lit(text.SYSTEM).alias("system"), F.col("prompt").alias("user"), "path", "hunk_header"), path)


@query(
    f"""with {diffs.NUMBERED_CTE}, h as (select doc, f, h, max(header) as header, string_agg(line, chr(10) order by pos) as raw from numbered group by all),
    named as (select doc, f, path from ({diffs.FILES_SQL}))
    select h.doc, path, header as hunk_header, md5('Repository: r/n' || chr(10) || 'Pull request: #7' || chr(10) || 'File: ' || path || chr(10) || chr(10) || '```diff' || chr(10)
      || regexp_replace(raw, '{text.WS}+\\z', '') || chr(10) || '```') as prompt
    from h join named using (doc, f)"""
)
def review_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hunks of all sample diffs with their prompts."""
    hunks = hunks_of(diffs.sample_diffs(load(spark, sf_dir, "review_comments")))
    prompt = text.user_prompt(F.lit("r/n"), F.lit(7), F.col("path"), F.col("raw"))
    return hunks.select("doc", "path", F.col("header").alias("hunk_header"), F.md5(prompt).alias("prompt"))


@query()
def stub_review_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff to findings with the stub; (finding_id, path, cited_line, grounded).  Its parts have SQL of their own."""
    made, _ = review(diffs.sample_diffs(load(spark, sf_dir, "review_comments")), "r/n", 7, "s", "2025-01-01T00:00:00Z")
    return made.select("finding_id", "path", "cited_line", "grounded")


@query(
    f"""with {curation.FUNNEL_CTE}, n as (select count(*) as seen, {", ".join(f"count(*) filter (where reason = '{r}') as {r}" for r in curation.REASONS)} from funnel)
    select counter, n::bigint as n from (unpivot n on * into name counter value n)"""
)
def curate_to_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in several files, in input order, through the whole funnel into chat records as JSON lines; the counters."""
    from hunkmill import schemas, workspace

    fields = [f.name for f in schemas.REVIEW_COMMENT.fields]
    rows = load(spark, sf_dir, "review_comments")
    top = rows.agg(F.max("delivery_id").alias("m")).first().m or 0
    paths, cuts = [], [top * k // 3 for k in range(4)]
    for k in range(3):
        part = rows.where((F.col("delivery_id") > (cuts[k] if k else -1)) & (F.col("delivery_id") <= cuts[k + 1]))
        paths.append(workspace.scratch_path(spark, "raw"))
        jsonl.overwrite(part.orderBy("delivery_id").select(*fields), paths[-1])
    counts = curate_files(spark, paths, workspace.scratch_path(spark, "curated"), curation.MIN_SCORE)
    return spark.createDataFrame(sorted(counts.items()), "counter string, n bigint")
