"""HTML reports of pull requests, as rows: each fragment is a row with its place, a report their concatenation.

A pull request's report is one text by nature; everything before that last step is distributed by fragment.
Missing users are shown as ``?``; blank bodies give no fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill.functions import duck, text
from hunkmill.operators import diffs
from hunkmill.registry import query
from hunkmill.workspace import load

# The elements' class names, which readers' own styles rely on; the style itself is this module's.
CSS = (
    "body{font:14px/1.5 system-ui,sans-serif;max-width:60rem;margin:2rem auto}table.hunk{border-collapse:collapse;width:100%;font-family:monospace}"
    ".add{background:#e6ffec}.del{background:#ffebe9}.lno{color:#6e7781;text-align:right}.cmt{border-left:3px solid #8c959f;padding:.2rem .6rem}"
    ".banner{background:#ddf4ff;padding:.4rem .8rem}.warn{background:#fff8c5}.tag{border:1px solid;border-radius:3px;padding:0 .3rem}"
)
TAGS = {"accept": "accepted", "reject": "rejected", "unsure": "unsure"}
BLOCKS = ("head", "body", "banner", "warning", "discussion", "file", "human", "critic", "hunk")


def _show(*parts: Column | str) -> Column:
    """Concatenation in which a null part is empty."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def _who(user: str) -> Column:
    return text.escape_html(F.coalesce(F.col(f"{user}.login"), F.lit("?")))


def _lno(line: Column) -> Column:
    return F.when(line.isNotNull(), F.concat(F.lit(' <span class="lno">L'), line.cast("string"), F.lit("</span>")))


def _cut(s: str, most: int) -> Column:
    return text.escape_html(text.truncate(F.col(s), most))


def head_html() -> Column:
    """Title, author, base and counts of a pull request."""
    e = text.escape_html
    return _show(
        "<style>\n", CSS, "\n</style>\n<h1><a href=\"", e(F.col("html_url")), '">PR #', F.col("number"), '</a></h1>\n<p class="title">', e(F.col("title")),
        '</p>\n<p class="meta">by <b>', _who("user"), "</b> into <code>", e(F.col("base.ref")), "</code> · ", F.col("changed_files"),
        ' files · <span class="add">+', F.col("additions"), '</span> <span class="del">−', F.col("deletions"), "</span></p>\n",
    )


def body_html() -> Column:
    body = text.trim(F.col("body"))
    shown = _show('<div class="cmt">', text.escape_html(text.truncate(body, 1200)), "</div>\n")
    return F.when(F.coalesce(body, F.lit("")) != "", shown)


def discussion_html() -> Column:
    return _show('<div class="cmt"><span class="who">', _who("user"), "</span> ", _cut("body", 800), "</div>\n")


def human_html() -> Column:
    line = _lno(F.coalesce("line", "original_line"))
    return _show('<div class="cmt human"><span class="who">', _who("user"), "</span>", line, " ", _cut("body", 600), "</div>\n")


def critic_html() -> Column:
    """A finding with its tags, and the judge's reason under it."""
    def tag(kind: str, label: str) -> str:
        return f' <span class="tag {kind}">{label}</span>'

    human, machine = F.col("human.verdict"), F.col("machine.verdict")
    human_tag, machine_tag = F.lit(""), F.lit("")
    for v, past in TAGS.items():
        human_tag = F.when(human == v, tag(v, past)).otherwise(human_tag)
        machine_tag = F.when(machine == v, tag(f"j{v}", f"judge: {v}")).otherwise(machine_tag)
    loose = F.when(F.col("grounded"), "").otherwise(tag("ungrounded", "ungrounded"))
    waiting = F.when(human.isNull() & machine.isNull(), tag("pending", "unjudged")).otherwise("")
    said = text.strip_verdict(F.col("machine.reason"))
    reason = _show('<div class="cmt judge-reason"><span class="who">', text.escape_html(F.col("machine.judged_by")), "</span>", text.escape_html(text.truncate(said, 600)), "</div>\n")
    return _show(
        '<div class="cmt critic"><span class="who">critic</span>', _lno(F.col("cited_line")), loose, human_tag, machine_tag, waiting, " ",
        _cut("critic_comment", 800), "</div>\n", F.when(F.coalesce(said, F.lit("")) != "", reason),
    )


def banner_html(model: Column, n: Column, files: Column, hunks: Column, grounded: Column, human: Column, machine: Column) -> Column:
    stub = F.when(model == "stub", " <b>(stub — no adapter wired yet)</b>")
    return _show(
        '<div class="banner">Critic: <code>', text.escape_html(F.coalesce(model, F.lit("none"))), "</code>", stub, " · ", n, " findings over ", files,
        " files / ", hunks, " hunks · ", grounded, " grounded · ", human, " human-judged · ", machine, " machine-judged</div>\n",
    )


def warning_html(failures: int) -> str:
    """The notice on hunks that failed; empty without any."""
    if not failures:
        return ""
    return f'<div class="banner warn">⚠ The review of {failures} hunk(s) failed, also when tried again; findings may be missing below.</div>\n'


def hunk_tables(lines: DataFrame) -> DataFrame:
    """(doc, f, h, html): a table per hunk with both line numbers."""
    cls = {"add": "+", "del": "−", "ctx": " "}
    mark = F.lit(" ")
    for kind, shown in cls.items():
        mark = F.when(F.col("kind") == kind, shown).otherwise(mark)
    row = _show(
        '<tr class="', F.col("kind"), '"><td class="lno">', F.col("old_no"), '</td><td class="lno">', F.col("new_no"), '</td><td class="code">', mark,
        "<span>", text.escape_html(F.col("text")), "</span></td></tr>\n",
    )
    rows = diffs.numbered(lines).select("doc", "f", "h", "pos", row.alias("row"))
    packed = rows.groupBy("doc", "f", "h").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "row"))), lambda x: x["row"]), "").alias("rows"))
    heads = diffs.hunks(lines).select("doc", "f", "h", "header")
    html = _show('<table class="hunk">\n<tr class="hdr"><td colspan="3">', text.escape_html(F.col("header")), "</td></tr>\n", F.col("rows"), "</table>\n")
    return heads.join(packed, ["doc", "f", "h"], "left").select("doc", "f", "h", html.alias("html"))


def fragments(prs: DataFrame, issues: DataFrame, comments: DataFrame, findings: DataFrame) -> DataFrame:
    """(repo, pr, place, html) of the parts of every report; place orders them."""
    def place(block: str, path: Column, at: Column) -> Column:
        return F.struct(F.lit(BLOCKS.index(block) if block not in ("human", "critic") else BLOCKS.index("file")).alias("block"), path.alias("path"), F.lit(BLOCKS.index(block)).alias("kind"), at.cast("string").alias("at"))

    none, pad = F.lit(""), lambda c: F.lpad(c.cast("string"), 20, "0")
    key = [F.col("repo"), F.col("number").alias("pr")]
    url = F.col("pull_request_url")
    said = comments.where("path is not null").withColumns({"repo": text.repo_of(url), "pr": text.pr_number(url)})
    parts = [
        prs.select(*key, place("head", none, none).alias("place"), head_html().alias("html")),
        prs.select(*key, place("body", none, none).alias("place"), body_html().alias("html")),
        issues.select("repo", "pr", place("discussion", none, pad(F.col("comment_id"))).alias("place"), discussion_html().alias("html")),
        said.select("repo", "pr", place("human", F.col("path"), pad(F.col("delivery_id"))).alias("place"), human_html().alias("html")),
        findings.select("repo", "pr", place("critic", F.col("path"), F.concat("session_id", F.lit(" "), "finding_id")).alias("place"), critic_html().alias("html")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("html is not null")


def reports(parts: DataFrame) -> DataFrame:
    """(repo, pr, html): the fragments of a pull request in order."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "html")))
    return parts.groupBy("repo", "pr").agg(F.array_join(F.transform(ordered, lambda x: x["html"]), "").alias("html"))


def latest_fetch(prs: DataFrame) -> DataFrame:
    """One row per pull request: the one fetched last."""
    fields = [c for c in prs.columns if c not in ("repo", "number")]
    return prs.groupBy("repo", "number").agg(F.max_by(F.struct(*fields), "fetched_at").alias("r")).select("repo", "number", "r.*")


# -- queries -------------------------------------------------------------------------------


def esc_sql(e: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        e = f"replace({e}, '{a}', '{b}')"
    return e


def cut_sql(e: str, n: int) -> str:
    return esc_sql(f"case when length({e}) > {n} then left({e}, {n}) || '…' else {e} end")


@query(f"select doc_id, md5({cut_sql('text', 120)}) as html from documents where text is not null")
def escape_truncate_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").where("text is not null")
    return rows.select("doc_id", F.md5(_cut("text", 120)).alias("html"))


@query(
    f"""select delivery_id, '<div class="cmt human"><span class="who">' || {esc_sql("coalesce(user.login, '?')")} || '</span>'
    || coalesce(' <span class="lno">L' || coalesce(line, original_line) || '</span>', '') || ' ' || coalesce({cut_sql('body', 600)}, '') || '</div>' || chr(10) as html
    from review_comments where path is not null"""
)
def render_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "review_comments").where("path is not null").select("delivery_id", human_html().alias("html"))


@query(
    f"""select comment_id, '<div class="cmt"><span class="who">' || {esc_sql("coalesce(user.login, '?')")} || '</span> ' || coalesce({cut_sql('body', 800)}, '') || '</div>' || chr(10) as html
    from issue_comments"""
)
def render_discussion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "issue_comments").select("comment_id", discussion_html().alias("html"))


_REASON = rf"regexp_replace({duck.trim_start('machine.reason')}, '^(?:ACCEPT|REJECT|UNSURE|Accept|Reject|Unsure)[:., \n\r-]*', '')"


@query(
    f"""select session_id, finding_id, '<div class="cmt critic"><span class="who">critic</span>' || coalesce(' <span class="lno">L' || cited_line || '</span>', '')
    || case when grounded then '' else ' <span class="tag ungrounded">ungrounded</span>' end
    || coalesce(' <span class="tag ' || human.verdict || '">' || case human.verdict when 'accept' then 'accepted' when 'reject' then 'rejected' else 'unsure' end || '</span>', '')
    || coalesce(' <span class="tag j' || machine.verdict || '">judge: ' || machine.verdict || '</span>', '')
    || case when human is null and machine is null then ' <span class="tag pending">unjudged</span>' else '' end || ' ' || {cut_sql('critic_comment', 800)} || '</div>' || chr(10)
    || case when coalesce({_REASON}, '') <> '' then '<div class="cmt judge-reason"><span class="who">' || {esc_sql('machine.judged_by')} || '</span>' || {cut_sql(_REASON, 600)} || '</div>' || chr(10) else '' end as html
    from critic_findings"""
)
def render_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "critic_findings").select("session_id", "finding_id", critic_html().alias("html"))


@query("select path, id, delivery_id, row_number() over (partition by path order by delivery_id) as place from review_comments where path is not null")
def file_comment_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of each path in input order, one row each; a path's comments are sorted, never gathered."""
    place = F.row_number().over(W.partitionBy("path").orderBy("delivery_id"))
    return load(spark, sf_dir, "review_comments").where("path is not null").select("path", "id", "delivery_id", place.cast("bigint").alias("place"))


@query("select repo, number, max(fetched_at) as fetched_at, arg_max(changed_files, fetched_at) as changed_files from pr_meta group by all")
def pr_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_fetch(load(spark, sf_dir, "pr_meta")).select("repo", "number", "fetched_at", "changed_files")


@query()
def pr_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(repo, pr, html) of every pull request; the parts' queries have SQL."""
    parts = fragments(
        latest_fetch(load(spark, sf_dir, "pr_meta")), load(spark, sf_dir, "issue_comments"), load(spark, sf_dir, "review_comments"), load(spark, sf_dir, "critic_findings")
    )
    return reports(parts)


@query()
def render_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, f, h, html): hunk tables of the sample diffs."""
    return hunk_tables(diffs.lines_of(diffs.sample_diffs(load(spark, sf_dir, "review_comments")), "doc", "diff"))
