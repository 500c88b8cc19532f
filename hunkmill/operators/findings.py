"""Findings: the stub critic, grounding, identifiers, the store's merge, verdicts, labels and tallies.

Nulls: a finding that cites no line is grounded; a null verdict counts as unjudged; null fields of an
identifier are empty texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import workspace
from hunkmill.functions import duck, text
from hunkmill.operators.diffs import hunk_start
from hunkmill.registry import query
from hunkmill.workspace import load

STUB = "stub"
# Fixed value: what the stub says of a hunk, before and behind its header.
STUB_BODY = (
    "[stub critic — no adapter wired yet] would review hunk `",
    "`. Real findings replace this once the LoRA endpoint is connected.",
)
VERDICTS = ("accept", "reject", "unsure")


def new_line_range(raw: Column) -> tuple[Column, Column]:
    """First and last new line number of a hunk's raw text, without taking it apart into rows.

    The last is the start plus one less than the hunk's context and added lines; the start if it has none.
    """
    lines = F.split(F.regexp_replace(raw, r"\n\z", ""), "\n")
    body = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    new = F.size(F.filter(body, lambda line: ~F.substring(line, 1, 1).isin("-", "\\")))
    start = hunk_start(F.element_at(lines, 1), r"\+")
    return start, start + F.greatest(new - 1, F.lit(0))


def grounded(cited: Column, raw: Column) -> Column:
    low, high = new_line_range(raw)
    return cited.isNull() | F.coalesce(cited.between(low, high), F.lit(False))


def first_added(raw: Column) -> Column:
    """New line number of a hunk's first added line, its start if it adds nothing."""
    lines = F.split(F.regexp_replace(raw, r"\n\z", ""), "\n")
    body = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    at = F.array_position(F.transform(body, lambda line: F.substring(line, 1, 1)), "+")
    before = F.size(F.filter(F.slice(body, F.lit(1), F.greatest(at.cast("int") - 1, F.lit(0))), lambda x: ~F.substring(x, 1, 1).isin("-", "\\")))
    start = hunk_start(F.element_at(lines, 1), r"\+")
    return F.when(at > 0, start + before).otherwise(start)


def finding_id(model: Column, repo: Column, pr: Column, path: Column, header: Column, body: Column) -> Column:
    """The stable identifier: who said what of which hunk, whatever the session and the cited line."""
    fields = (model, repo, F.coalesce(pr, F.lit(0)).cast("string"), path, header, body)
    return text.fnv1a(*(F.coalesce(f, F.lit("")) for f in fields))


def stub_review(hunks: DataFrame, *carried: str) -> DataFrame:
    """One finding per hunk (repo, pr, path, hunk_header, hunk_raw), as column expressions only.

    ``carried`` columns go along unchanged.
    """
    comment = F.concat(F.lit(STUB_BODY[0]), F.col("hunk_header"), F.lit(STUB_BODY[1]))
    cited = first_added(F.col("hunk_raw"))
    return hunks.select(
        *carried,
        finding_id(F.lit(STUB), F.col("repo"), F.col("pr"), F.col("path"), F.col("hunk_header"), comment).alias("finding_id"),
        F.lit(STUB).alias("model_version"), "repo", "pr", "path", "hunk_header", "hunk_raw",
        comment.alias("critic_comment"), cited.alias("cited_line"), grounded(cited, F.col("hunk_raw")).alias("grounded"),
    )


def merge_findings(store: DataFrame, fresh: DataFrame, order: str, keep_machine: bool = False) -> DataFrame:
    """Upsert by ``finding_id``: fresh rows replace stored ones except for the human label.

    Of fresh rows with one identifier the last by ``order`` counts.  A machine verdict is lost with the row
    it judged, as the results to match have it, unless ``keep_machine``.  Stored rows come first, in their
    order, then the new ones in theirs; ``place`` says so.
    """
    last = fresh.groupBy("finding_id").agg(F.max_by(F.struct(*[c for c in fresh.columns if c != "finding_id"]), order).alias("new"))
    old = store.groupBy("finding_id").agg(F.min_by(F.struct(*[c for c in store.columns if c != "finding_id"]), order).alias("old"))
    both = old.join(last, "finding_id", "full_outer")
    fields = [c for c in store.columns if c not in ("finding_id", "human", "machine", order)]
    machine = F.coalesce("new.machine", "old.machine") if keep_machine else F.when(F.col("new").isNull(), F.col("old.machine")).otherwise(F.col("new.machine"))
    return both.select(
        "finding_id",
        *(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in fields),
        F.coalesce("old.human", "new.human").alias("human"),
        machine.alias("machine"),
        F.struct(F.col("old").isNull().alias("added"), F.coalesce(F.col(f"old.{order}"), F.col(f"new.{order}")).alias("at")).alias("place"),
    )


def tally(findings: DataFrame, verdict: Column, *by: str) -> DataFrame:
    """Accepted, rejected and unsure findings."""
    counts = [F.count_if(verdict == v).alias(v) for v in VERDICTS]
    return findings.groupBy(*by).agg(*counts) if by else findings.agg(*counts)


def pending(findings: DataFrame, again: bool = False) -> DataFrame:
    """Findings without a machine verdict; all of them if they are to be judged again."""
    return findings if again else findings.where("machine is null")


def with_verdict(findings: DataFrame, verdict: str) -> DataFrame:
    """Findings whose machine verdict is the one named; names are checked before anything runs."""
    names = {"accepted": "accept", "accept": "accept", "rejected": "reject", "reject": "reject", "unsure": "unsure"}
    if verdict not in names:
        raise ValueError(f"unknown verdict {verdict!r}: one of {', '.join(sorted(names))}")
    return findings.where(F.col("machine.verdict") == names[verdict])


def apply_replies(findings: DataFrame, replies: DataFrame, judge: str) -> DataFrame:
    """Machine labels from the judge's replies (finding_id, reply, judged_at); a null reply leaves the finding as it is."""
    said = replies.where("reply is not null")
    label = F.struct(
        text.parse_verdict(F.col("reply")).alias("verdict"), text.verdict_reason(F.col("reply")).alias("reason"),
        F.col("judged_at").alias("judged_at"), F.lit(judge).alias("judged_by"),
    )
    joined = findings.join(said.select("finding_id", label.alias("label")), "finding_id", "left")
    return joined.withColumn("machine", F.coalesce("label", "machine")).drop("label")


def apply_decisions(findings: DataFrame, decisions: DataFrame, by: str) -> DataFrame:
    """Human labels from decisions (finding_id, turn, choice, note, judged_at), answered in the order of ``turn``.

    The first letter counts: a accept, r reject, u unsure, q ends the session; anything else skips.
    """
    first = F.lower(F.substring(text.trim(F.coalesce("choice", F.lit(""))), 1, 1))
    coded = decisions.withColumn("key", first)
    stop = coded.where("key = 'q'").agg(F.min("turn").alias("stop")).first().stop
    live = coded if stop is None else coded.where(F.col("turn") < stop)
    verdict = F.when(F.col("key") == "a", "accept").when(F.col("key") == "r", "reject").when(F.col("key") == "u", "unsure")
    design = F.when(F.col("key") == "a", True).when(F.col("key") == "r", False)
    note = F.nullif(text.trim(F.coalesce("note", F.lit(""))), F.lit(""))
    label = F.struct(
        verdict.alias("verdict"), design.alias("is_design_problem"), F.lit(None).cast("string").alias("severity"), note.alias("note"),
        F.col("judged_at").alias("judged_at"), F.lit(by).alias("judged_by"),
    )
    given = live.where(verdict.isNotNull()).groupBy("finding_id").agg(F.max_by(label, "turn").alias("label"))
    joined = findings.join(given, "finding_id", "left")
    return joined.withColumn("human", F.coalesce("label", "human")).drop("label")


# -- queries -------------------------------------------------------------------------------


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "critic_findings")


RANGE_SQL = r"""ranged as (
  select *, coalesce(try_cast(regexp_extract(hunk_raw, '^@@ -[0-9,]+ \+([0-9]+)', 1) as bigint), 0) as low,
    len(list_filter(string_split(hunk_raw, chr(10))[2:], lambda l: not (starts_with(l, '-') or starts_with(l, '\')))) as news,
    list_position(list_transform(string_split(hunk_raw, chr(10))[2:], lambda l: left(l, 1)), '+') as added_at
  from critic_findings)"""


@query(
    f"""with {RANGE_SQL} select finding_id, session_id, coalesce(cited_line between low and low + greatest(news - 1, 0), true) as grounded,
    low, low + greatest(news - 1, 0) as high from ranged"""
)
def grounding_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = new_line_range(F.col("hunk_raw"))
    return _findings(spark, sf_dir).select(
        "finding_id", "session_id", grounded(F.col("cited_line"), F.col("hunk_raw")).alias("grounded"), low.alias("low"), high.alias("high")
    )


@query(
    f"""select finding_id, session_id,
    {duck.fnv1a("coalesce(model_version, '')", "coalesce(repo, '')", "coalesce(pr, 0)::varchar", "coalesce(path, '')", "coalesce(hunk_header, '')", "coalesce(critic_comment, '')")}
    as fnv from critic_findings"""
)
def fnv_finding_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("model_version", "repo", "pr", "path", "hunk_header", "critic_comment")
    return _findings(spark, sf_dir).select("finding_id", "session_id", finding_id(*map(F.col, names)).alias("fnv"))


@query(
    f"""with {RANGE_SQL} select session_id, finding_id as stored_id, case when added_at > 0 then low + len(list_filter(string_split(hunk_raw, chr(10))[2:added_at],
      lambda l: not (starts_with(l, '-') or starts_with(l, '\\')))) else low end as cited_line,
    {duck.quoted(STUB_BODY[0])} || hunk_header || {duck.quoted(STUB_BODY[1])} as critic_comment, true as grounded from ranged""".replace("'\\\\'", "'\\'")
)
def stub_critic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _findings(spark, sf_dir).withColumnRenamed("finding_id", "stored_id")
    return stub_review(rows, "session_id", "stored_id").select("session_id", "stored_id", "cited_line", "critic_comment", "grounded")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored findings, and a later session that finds those of the stub model again and some new ones."""
    rows = _findings(spark, sf_dir).select("finding_id", "session_id", "critic_comment", "human", "machine")
    none = F.lit(None)
    again = rows.select(
        F.when(F.col("finding_id") < "8", F.col("finding_id")).otherwise(F.concat(F.lit("n"), F.col("finding_id"))).alias("finding_id"),
        F.concat(F.lit("z-"), F.col("session_id")).alias("session_id"), F.upper("critic_comment").alias("critic_comment"),
        none.cast(rows.schema["human"].dataType).alias("human"), none.cast(rows.schema["machine"].dataType).alias("machine"),
    )
    return rows, again


def _merge_sql(machine: str) -> str:
    return f"""with old as (select finding_id, min(session_id) as first from critic_findings group by 1),
    old2 as (select f.finding_id, f.session_id, f.critic_comment, f.human.verdict as human, f.machine.verdict as machine from critic_findings f join old on old.finding_id = f.finding_id and old.first = f.session_id),
    new as (select case when finding_id < '8' then finding_id else 'n' || finding_id end as finding_id, max('z-' || session_id) as session_id, max_by(upper(critic_comment), session_id) as critic_comment
      from critic_findings group by 1)
    select finding_id, coalesce(n.session_id, o.session_id) as session_id, coalesce(n.critic_comment, o.critic_comment) as critic_comment,
      human, {machine} as machine from old2 o full join new n using (finding_id)"""


def _merged(spark: SparkSession, sf_dir: str, keep_machine: bool) -> DataFrame:
    store, fresh = _halves(spark, sf_dir)
    store, fresh = (x.withColumn("at", F.col("session_id")) for x in (store, fresh))
    out = merge_findings(store, fresh, "at", keep_machine)
    return out.select("finding_id", "session_id", "critic_comment", F.col("human.verdict").alias("human"), F.col("machine.verdict").alias("machine"))


@query(_merge_sql("case when n.finding_id is null then machine end"))
def judge_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, keep_machine=False)


@query(_merge_sql("machine"))
def merge_keep_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, keep_machine=True)


VERDICT_SQL = """case when least(a, r, u) = 1000000 then 'unsure' when a < r and a < u then 'accept' when r < u then 'reject' else 'unsure' end"""


@query(
    f"""with placed as (select *, {", ".join(f"coalesce(nullif(instr(upper(machine.reason), '{w}'), 0), 1000000) as {w[0].lower()}" for w in text.VERDICTS)}
      from critic_findings where machine.reason is not null)
    select finding_id, session_id, {VERDICT_SQL} as verdict, {duck.trim("machine.reason")} as reason,
      regexp_replace({duck.trim_start("machine.reason")}, '^(?:ACCEPT|REJECT|UNSURE|Accept|Reject|Unsure)[:., \\n\\r-]*', '') as stripped from placed"""
)
def verdict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.col("machine.reason")
    return _findings(spark, sf_dir).where(reply.isNotNull()).select(
        "finding_id", "session_id", text.parse_verdict(reply).alias("verdict"), text.verdict_reason(reply).alias("reason"), text.strip_verdict(reply).alias("stripped")
    )


def _tally_sql(field: str) -> str:
    return ", ".join(f"count(*) filter (where {field}.verdict = '{v}') as {v}" for v in VERDICTS)


@query(f"select {_tally_sql('machine')} from critic_findings")
def verdict_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(_findings(spark, sf_dir), F.col("machine.verdict"))


@query(f"select repo, pr, model_version, {_tally_sql('machine')}, round(avg((machine.verdict = 'accept')::integer), 6) as rate from critic_findings where machine is not null group by 1, 2, 3")
def accept_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The judge's accept rate per pull request and model, as a meter of drift."""
    judged = _findings(spark, sf_dir).where("machine is not null")
    v = F.col("machine.verdict")
    rate = F.round(F.avg((v == "accept").cast("int")), 6).alias("rate")
    return judged.groupBy("repo", "pr", "model_version").agg(*[F.count_if(v == x).alias(x) for x in VERDICTS], rate)


@query(
    """select count(*) as findings, count(*) filter (where grounded) as grounded, count(human) as human, count(machine) as machine,
    count(*) filter (where human is null and machine is null) as unjudged from critic_findings"""
)
def finding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, sf_dir).agg(
        F.count("*").alias("findings"), F.count_if("grounded").alias("grounded"), F.count("human").alias("human"), F.count("machine").alias("machine"),
        F.count_if(F.col("human").isNull() & F.col("machine").isNull()).alias("unjudged"),
    )


@query("select finding_id, session_id from critic_findings where machine is null")
def judge_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending(_findings(spark, sf_dir)).select("finding_id", "session_id")


@query("select finding_id, session_id from critic_findings where machine.verdict = 'accept'")
def verdict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_verdict(_findings(spark, sf_dir), "accepted").select("finding_id", "session_id")


@query("select f.finding_id, f.session_id from critic_findings f where repo = (select min(repo) from critic_findings) and pr is not null")
def repo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _findings(spark, sf_dir)
    first = rows.agg(F.min("repo").alias("least"))
    return rows.where("pr is not null").join(F.broadcast(first), F.col("repo") == F.col("least"), "left_semi").select("finding_id", "session_id")


DECISIONS_SQL = """decisions as (
  select finding_id, turn, case turn % 5 when 0 then ' Accept' when 1 then 'r' when 2 then 'U' when 3 then '' else 'x' end as choice from (
    select finding_id, row_number() over (order by finding_id) as turn from (select distinct finding_id from critic_findings)))"""


@query(
    f"""with {DECISIONS_SQL} select f.finding_id, session_id,
      coalesce(case turn % 5 when 0 then 'accept' when 1 then 'reject' when 2 then 'unsure' end, human.verdict) as verdict,
      case turn % 5 when 0 then true when 1 then false when 2 then null else human.is_design_problem end as design
    from critic_findings f join decisions using (finding_id)"""
)
def label_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels by a table of decisions; turns number the identifiers in order (range partitions, then offsets)."""
    rows = _findings(spark, sf_dir)
    ids = number_rows(rows.select("finding_id").distinct(), "finding_id", "turn")
    m = F.pmod("turn", F.lit(5))
    choice = F.when(m == 0, " Accept").when(m == 1, "r").when(m == 2, "U").when(m == 3, "").otherwise("x")
    decisions = ids.select("finding_id", "turn", choice.alias("choice"), F.lit(" ").alias("note"), F.lit("2025-01-01T00:00:00Z").alias("judged_at"))
    out = apply_decisions(rows, decisions, "reviewer")
    return out.select("finding_id", "session_id", F.col("human.verdict").alias("verdict"), F.col("human.is_design_problem").alias("design"))


def number_rows(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Rows numbered from 1 in the order of a column without repeats, in parallel.

    Rows are range-partitioned, sorted and written once with their partition's number and their place in it;
    the partitions' sizes, one row each, give the offsets.  Both read the written table: two shuffles of the
    same rows needn't be cut or merged alike.
    """
    from pyspark.sql import Window as W

    at = F.monotonically_increasing_id()  # the partition's number, then 33 bits for the place
    ranged = workspace.keep(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", at), "ranged")
    ranged = ranged.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1})
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = ranged.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return numbered.withColumn(name, F.col("_row") + F.col("_before")).drop("_part", "_row", "_before", "_at")


HUNKS_SQL = "select path, regexp_extract(diff_hunk, '^[^\\n]*') as header, delivery_id from review_comments where path is not null and diff_hunk is not null"


@query(
    f"""with hunks as ({HUNKS_SQL}) select delivery_id from hunks where (path, header) in (select path, hunk_header from critic_findings where machine.verdict = 'accept')"""
)
def semi_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hunks on which an accepted finding stands."""
    kept = with_verdict(_findings(spark, sf_dir), "accept").select("path", F.col("hunk_header").alias("header"))
    return _hunk_rows(spark, sf_dir).join(kept, ["path", "header"], "left_semi").select("delivery_id")


@query(
    f"""with hunks as ({HUNKS_SQL}) select delivery_id from hunks h where not exists (
    select 1 from critic_findings f where f.path = h.path and f.hunk_header = h.header)"""
)
def uncommented_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hunks without any finding."""
    found = _findings(spark, sf_dir).select("path", F.col("hunk_header").alias("header"))
    return _hunk_rows(spark, sf_dir).join(found, ["path", "header"], "left_anti").select("delivery_id")


def _hunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "review_comments").where("path is not null and diff_hunk is not null")
    return rows.select("path", F.regexp_extract("diff_hunk", r"^[^\n]*", 0).alias("header"), "delivery_id")


OVERLAP_LINES = 3


@query(
    f"""select distinct f.finding_id, f.session_id, exists (select 1 from review_comments c where c.path = f.path
      and {duck.repo_of('c.pull_request_url')} = f.repo and {duck.pr_number('c.pull_request_url')} = f.pr
      and coalesce(c.line, c.original_line) between f.cited_line - {OVERLAP_LINES} and f.cited_line + {OVERLAP_LINES}) as raised
    from critic_findings f"""
)
def already_raised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a human comment stands within a few lines of a finding.

    The line interval is cut into buckets as wide as the reach; a finding looks into three, so the join is
    by equality and no hot file is paired with all its findings.
    """
    url, wide = F.col("pull_request_url"), OVERLAP_LINES
    line = F.coalesce("line", "original_line")
    comments = load(spark, sf_dir, "review_comments").select(
        text.repo_of(url).alias("repo"), text.pr_number(url).alias("pr"), "path", line.alias("at"), F.floor(line / wide).alias("bucket")
    ).where("at is not null").distinct()
    rows = _findings(spark, sf_dir).select("finding_id", "session_id", "repo", "pr", "path", "cited_line").distinct()
    around = F.explode(F.array(*[F.floor(F.col("cited_line") / wide) + d for d in (-1, 0, 1)]))
    near = rows.where("cited_line is not null").withColumn("bucket", around).join(comments, ["repo", "pr", "path", "bucket"])
    hit = near.where(F.abs(F.col("at") - F.col("cited_line")) <= wide).select("finding_id", "session_id").distinct()
    marked = rows.select("finding_id", "session_id").distinct().join(hit.withColumn("raised", F.lit(True)), ["finding_id", "session_id"], "left")
    return marked.withColumn("raised", F.coalesce("raised", F.lit(False)))
