"""From raw review comments to chat records: keep-first, reply counts, the drop funnel, scores, records.

Input order is the order of arrival, ``delivery_id``.  Nulls: a null body is the empty one; a null user
is no bot; a null path or hunk drops the row as ``no_diff``; a null identifier is its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill.functions import duck, text
from hunkmill.registry import query
from hunkmill.workspace import load, spread, where_once

MIN_SCORE = 0.4
REASONS = ("dup", "reply", "bot", "no_diff", "trivial", "low_score", "kept")


def reply_counts(comments: DataFrame) -> DataFrame:
    """(root, replies) over all rows, repeated and bot replies included."""
    replies = comments.where("in_reply_to_id is not null")
    return replies.groupBy(F.col("in_reply_to_id").alias("root")).agg(F.count("*").alias("replies"))


def mark_first(comments: DataFrame, key: str = "id", order: str = "delivery_id") -> DataFrame:
    """With ``is_first``: whether the row is the first of its key in input order.

    A minimum per key, combined on the map side, and a join; a window would bring a hot key's rows
    into one task.
    """
    first = comments.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    joined = comments.join(first, F.col(key) == F.col("_key"), "left")
    return joined.withColumn("is_first", F.col(key).isNull() | (F.col(order) == F.col("_first"))).drop("_key", "_first")


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    return mark_first(rows, key, order).where("is_first").drop("is_first")


def funnel(comments: DataFrame, min_score: float = MIN_SCORE, min_len: int = 20) -> DataFrame:
    """With body cleaned, ``replies``, ``score``, ``category`` and ``reason``; the first matching reason counts.

    The cases run in order of cost, so the patterns only see rows that nothing cheaper has dropped.
    """
    slim = comments.select(
        "delivery_id", "id", "in_reply_to_id", F.col("user.login").alias("login"), "pull_request_url", "path", "diff_hunk",
        F.coalesce("body", F.lit("")).alias("raw"), (F.col("path").isNull() | F.col("diff_hunk").isNull()).alias("bare"),
    )
    # hunks are shuffled only if the result is asked for them
    marked = mark_first(spread(slim)).join(reply_counts(comments), F.col("id") == F.col("root"), "left").drop("root")
    cheap = (
        F.when(~F.col("is_first"), "dup")
        .when(F.col("in_reply_to_id").isNotNull(), "reply")
        .when(text.is_bot(F.col("login")), "bot")
        .when(F.col("bare"), "no_diff")
    )
    body = F.col("body")
    cleaned = marked.withColumn("reason", cheap).withColumn("replies", F.coalesce("replies", F.lit(0)))
    cleaned = cleaned.withColumn("body", F.when(F.col("reason").isNull(), text.clean_body(F.col("raw"))))
    # the patterns are the costly part, so their counts are columns of their own, made once
    design, nit = (F.when(F.col("reason").isNull(), text.hits(body, p)) for p in (text.DESIGN, text.NIT))
    counted = cleaned.withColumn("design", design).withColumn("nit", nit)
    signals = (body, F.col("replies"), F.col("design"), F.col("nit"))
    scored = counted.withColumn("score", F.when(F.col("reason").isNull(), text.score_of(*signals)))
    scored = scored.withColumn("category", F.when(F.col("reason").isNull(), text.category_of(*signals)))
    low = F.col("score") < F.lit(min_score).cast("float")
    late = F.when(text.is_trivial(body, min_len), "trivial").when(low, "low_score").otherwise("kept")
    return scored.withColumn("reason", F.coalesce("reason", late)).drop("raw", "bare", "is_first", "design", "nit")


def chat_records(curated: DataFrame, system: str = text.SYSTEM) -> DataFrame:
    """(messages, meta) of the kept rows of :func:`funnel`."""
    repo, pr = text.repo_of(F.col("pull_request_url")), text.pr_number(F.col("pull_request_url"))
    user = text.user_prompt(repo, pr, F.col("path"), F.col("diff_hunk"))

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    meta = F.struct(
        F.col("id").alias("source_id"), repo.alias("repo"), pr.alias("pr"), "path", "category",
        F.col("score").alias("design_score"), F.col("replies").cast("int").alias("reply_count"),
    )
    messages = F.array(message("system", F.lit(system)), message("user", user), message("assistant", F.col("body")))
    kept = where_once(curated, F.col("reason") == "kept")
    return kept.select(messages.alias("messages"), meta.alias("meta"))


def threshold_sweep(curated: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """(threshold, category, n, tokens): what each threshold would keep; a token is four bytes.

    One pass: every row adds to the buckets of all thresholds it reaches, without a join.
    """
    scored = where_once(curated, F.col("reason").isin("low_score", "kept")).select("score", "category", F.floor(F.octet_length("body") / 4).alias("tokens"))
    reached = [F.when(F.col("score") >= F.lit(t).cast("float"), F.lit(float(t))) for t in thresholds]
    rows = scored.select(F.explode(F.array_compact(F.array(*reached))).alias("threshold"), "category", "tokens")
    return rows.groupBy("threshold", "category").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))


FUNNEL_CTE = f"""
counts as (select in_reply_to_id as root, count(*) as replies from review_comments where in_reply_to_id is not null group by 1),
marked as (
  select r.*, coalesce(replies, 0) as replies, row_number() over (partition by id order by delivery_id) as place
  from review_comments r left join counts on id = root),
cheap as (
  select *, {duck.clean_body("coalesce(body, '')")} as cleaned,
    case when place > 1 then 'dup' when in_reply_to_id is not null then 'reply' when {duck.is_bot("user.login")} then 'bot'
      when path is null or diff_hunk is null then 'no_diff' end as early
  from marked),
scored as (
  select *, {duck.design_score("cleaned", "replies")} as score, {duck.category("cleaned", "replies")} as category from cheap),
funnel as (
  select *, coalesce(early, case when {duck.is_trivial("cleaned")} then 'trivial' when score < 0.4::float then 'low_score' else 'kept' end)
    as reason from scored)
"""


@query("select in_reply_to_id as root, count(*) as replies from review_comments where in_reply_to_id is not null group by 1")
def thread_reply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_counts(load(spark, sf_dir, "review_comments"))


@query(
    """select id, min(delivery_id) as delivery_id from review_comments where id is not null group by 1
    union all select id, delivery_id from review_comments where id is null"""
)
def keep_first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "review_comments").select("id", "delivery_id")
    return keep_first(rows, "id", "delivery_id")


@query("select text, min(doc_id) as doc_id from documents where text is not null group by 1 union all select text, doc_id from documents where text is null")
def keep_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(load(spark, sf_dir, "documents").select("text", "doc_id"), "text", "doc_id")


@query(f"select doc_id, md5({duck.strip_comments('text')}) as digest from documents")
def strip_html_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.md5(text.strip_html_comments(F.col("text"))).alias("digest"))


@query(f"select delivery_id, {duck.clean_body('body')} as body from review_comments")
def clean_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "review_comments").select("delivery_id", text.clean_body(F.col("body")).alias("body"))


@query(f"select doc_id, md5({duck.clean_body('text')}) as digest from documents")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_body(F.col("text"))).alias("digest"))


@query(f"select user.login as login, count(*) as n from review_comments where {duck.is_bot('user.login')} group by 1")
def bot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "review_comments").select(F.col("user.login").alias("login"))
    return rows.where(text.is_bot(F.col("login"))).groupBy("login").agg(F.count("*").alias("n"))


@query("select count(*) as roots, count(*) filter (where path is not null and diff_hunk is not null) as with_diff from review_comments where in_reply_to_id is null")
def root_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = load(spark, sf_dir, "review_comments").where("in_reply_to_id is null")
    return roots.agg(F.count("*").alias("roots"), F.count_if(F.col("path").isNotNull() & F.col("diff_hunk").isNotNull()).alias("with_diff"))


@query(f"select delivery_id, {duck.is_trivial(duck.clean_body('body'))} as trivial from review_comments where body is not null")
def trivial_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "review_comments").where("body is not null")
    return rows.select("delivery_id", text.is_trivial(text.clean_body(F.col("body"))).alias("trivial"))


def _signals() -> str:
    design, nit = (duck.hits("body", p) for p in (text.DESIGN, text.NIT))
    return f"select delivery_id, {design} as design, {nit} as nit, regexp_matches(body, '{text.QUESTION}') as question from review_comments"


@query(_signals())
def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("body")
    return load(spark, sf_dir, "review_comments").select(
        "delivery_id",
        text.hits(body, text.DESIGN).cast("bigint").alias("design"),
        text.hits(body, text.NIT).cast("bigint").alias("nit"),
        body.rlike(text.QUESTION).alias("question"),
    )


@query(f"with {FUNNEL_CTE} select delivery_id, reason, category, round(score::double, 4) as score from funnel where early is null")
def design_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = funnel(load(spark, sf_dir, "review_comments"))
    return where_once(curated, F.col("score").isNotNull()).select("delivery_id", "reason", "category", F.round(F.col("score").cast("double"), 4).alias("score"))


@query(f"with {FUNNEL_CTE} select reason, count(*) as n from funnel group by 1")
def curation_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(load(spark, sf_dir, "review_comments")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""with {FUNNEL_CTE} select category, count(*) as n, round(avg(score::double), 6) as mean_score, round(median(score::double), 6) as median_score
    from funnel where reason = 'kept' group by 1"""
)
def category_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = where_once(funnel(load(spark, sf_dir, "review_comments")), F.col("reason") == "kept").withColumn("s", F.col("score").cast("double"))
    return kept.groupBy("category").agg(
        F.count("*").alias("n"), F.round(F.avg("s"), 6).alias("mean_score"), F.round(F.median("s"), 6).alias("median_score")
    )


@query(
    f"""with {FUNNEL_CTE}, t as (select unnest([0.3, 0.4, 0.5])::double as threshold)
    select threshold, category, count(*) as n, sum(strlen(cleaned) // 4)::bigint as tokens
    from funnel join t on score >= threshold::float where reason in ('low_score', 'kept') group by 1, 2"""
)
def threshold_sweep_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_sweep(funnel(load(spark, sf_dir, "review_comments")), (0.3, 0.4, 0.5))


@query(
    f"""with {FUNNEL_CTE} select id as source_id, {duck.repo_of('pull_request_url')} as repo, {duck.pr_number('pull_request_url')} as pr, path, category,
      replies::integer as reply_count,
      md5({duck.user_prompt(duck.repo_of('pull_request_url'), duck.pr_number('pull_request_url'), 'path', 'diff_hunk')}) as prompt,
      md5(cleaned) as answer from funnel where reason = 'kept'"""
)
def chat_record_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = chat_records(funnel(load(spark, sf_dir, "review_comments")))
    return built.select(
        "meta.source_id", "meta.repo", "meta.pr", "meta.path", "meta.category", "meta.reply_count",
        F.md5(F.col("messages")[1]["content"]).alias("prompt"), F.md5(F.col("messages")[2]["content"]).alias("answer"),
    )


@query(f"select delivery_id, {duck.repo_of('pull_request_url')} as repo, {duck.pr_number('pull_request_url')} as pr from review_comments")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("pull_request_url")
    return load(spark, sf_dir, "review_comments").select("delivery_id", text.repo_of(url).alias("repo"), text.pr_number(url).alias("pr"))
