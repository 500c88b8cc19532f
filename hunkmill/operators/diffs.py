"""Unified diffs as rows: files, hunks and numbered lines, by windows over the lines.

All windows share the partitioning by document, so a diff is exchanged once however many of them there
are.  Line kinds are tested in a fixed order, binary and path headers before anything else, also inside
hunks; hunks in front of the first ``diff --git`` belong to no file and give no rows.

A null or empty diff gives no rows.  Carriage returns at line ends are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill.functions import text
from hunkmill.registry import query
from hunkmill.workspace import load

MARKS = (("F", "diff --git "), ("B", "Binary files "), ("M", "--- "), ("P", "+++ "), ("H", "@@"))


def header_path(rest: Column) -> Column:
    """The path in what follows ``diff --git ``: between the first two `` b/``, else without leading ``a/``."""
    parts = F.split(rest, " b/")
    return F.coalesce(F.try_element_at(parts, F.lit(2)), F.regexp_replace(rest, "^(?:a/)+", ""))


def marker_path(line: Column) -> Column:
    """The path of a ``---`` or ``+++`` line."""
    bare = text.trim(F.substring_index(F.substring(line, 5, 2**30), "\t", 1))
    return F.when(bare == "/dev/null", bare).otherwise(F.regexp_replace(bare, "^[ab]/", ""))


def hunk_start(header: Column, sign: str) -> Column:
    """The old (-) or new (+) start of a hunk header; 0 where there is no number."""
    inner = F.regexp_extract(header, "^@+(.*?)(?:@@|$)", 1)
    number = F.regexp_extract(F.concat(F.lit(" "), inner), rf".*\s{sign}([0-9]+)(?=[,\s]|$)", 1)
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def lines_of(diffs: DataFrame, doc: str, diff: str) -> DataFrame:
    """(doc, pos, line, mark, f, h): every line from the first file on, with its file and hunk number."""
    body = F.regexp_replace(F.col(diff), r"\n\z", "")
    rows = diffs.where(F.length(diff) > 0).select(F.col(doc).alias("doc"), F.posexplode(F.split(body, "\n")).alias("pos", "raw"))
    line = rows.select("doc", "pos", F.regexp_replace("raw", r"\r\z", "").alias("line"))
    mark = F.lit("L")
    for name, head in reversed(MARKS):
        mark = F.when(F.col("line").startswith(head), name).otherwise(mark)
    at = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    filed = line.withColumn("mark", mark).withColumn("f", F.sum((F.col("mark") == "F").cast("int")).over(at)).where("f > 0")
    inside = W.partitionBy("doc", "f").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return filed.withColumn("h", F.sum((F.col("mark") == "H").cast("int")).over(inside))


def files(lines: DataFrame) -> DataFrame:
    """(doc, f, path, old_path, status, binary, hunks) of every file of a diff."""
    before = W.partitionBy("doc", "f").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    m_at = F.max(F.when(F.col("mark") == "M", F.col("pos"))).over(before)
    p_at = F.max(F.when(F.col("mark") == "P", F.col("pos"))).over(before)
    m_path = F.last(F.when(F.col("mark") == "M", marker_path(F.col("line"))), ignorenulls=True).over(before)
    rows = lines.select("*", m_at.alias("m_at"), p_at.alias("p_at"), m_path.alias("old"), marker_path(F.col("line")).alias("new"))
    paired = (F.col("mark") == "P") & F.col("m_at").isNotNull() & (F.col("p_at").isNull() | (F.col("m_at") > F.col("p_at")))
    null = "/dev/null"
    status = (
        F.when(F.col("old") == null, "added").when(F.col("new") == null, "deleted").when(F.col("old") != F.col("new"), "renamed")
    )
    path = F.when((F.col("old") != null) & (F.col("new") == null), F.col("old")).otherwise(F.col("new"))
    old = F.when(F.col("old") == null, F.lit(None)).when((F.col("new") == null) | (F.col("old") != F.col("new")), F.col("old"))

    def final(value: Column) -> Column:
        hit = paired & value.isNotNull()
        return F.max_by(F.when(hit, value), F.when(hit, F.col("pos")))

    head = F.max(F.when(F.col("mark") == "F", header_path(F.substring(F.col("line"), 12, 2**30))))
    return rows.groupBy("doc", "f").agg(
        F.coalesce(final(path), head).alias("path"),
        final(old).alias("old_path"),
        F.coalesce(final(status), F.lit("modified")).alias("status"),
        F.max(F.col("mark") == "B").alias("binary"),
        F.max("h").alias("hunks"),
    )


def hunks(lines: DataFrame) -> DataFrame:
    """(doc, f, h, header, new_start, old_start, raw, last_new) of every hunk, the raw text verbatim.

    ``last_new`` is the highest new line number in the hunk, the start if it has none.  One aggregation over the
    numbered lines gives text, header and last line.
    """
    raw = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    top = F.max(F.when(F.col("kind").isin("ctx", "add"), F.col("new"))).alias("top")
    body = _in_hunks(lines).groupBy("doc", "f", "h").agg(raw.alias("raw"), F.min_by("line", "pos").alias("header"), top)
    start = hunk_start(F.col("header"), r"\+")
    return body.select(
        "doc", "f", "h", "header", start.alias("new_start"), hunk_start(F.col("header"), "-").alias("old_start"), "raw",
        F.coalesce("top", start).alias("last_new"),
    )


def _in_hunks(lines: DataFrame) -> DataFrame:
    """The lines of hunks with their kind and where both sides stand."""
    within = W.partitionBy("doc", "f", "h").orderBy("pos")
    before = within.rowsBetween(W.unboundedPreceding, -1)
    first = F.substring("line", 1, 1)
    kind = F.when(F.col("mark") == "H", "head").when(first == "+", "add").when(first == "-", "del").when(first == "\\", "note").otherwise("ctx")
    rows = lines.where("h > 0 and mark in ('H', 'L')").withColumn("kind", kind)
    header = F.first("line").over(within.rowsBetween(W.unboundedPreceding, 0))
    start = {sign: hunk_start(header, sign) for sign in ("-", r"\+")}
    seen = {side: F.coalesce(F.sum(F.col("kind").isin("ctx", side).cast("int")).over(before), F.lit(0)) for side in ("add", "del")}
    return rows.withColumn("new", start[r"\+"] + seen["add"]).withColumn("old", start["-"] + seen["del"])


def numbered(lines: DataFrame) -> DataFrame:
    """(doc, f, h, pos, kind, old_no, new_no, text) of every line in a hunk, without the no-newline note."""
    marked = F.substring("line", 1, 1).isin("+", "-", " ")
    return _in_hunks(lines).where("kind in ('ctx', 'add', 'del')").select(
        "doc", "f", "h", "pos", "kind",
        F.when(F.col("kind") != "add", F.col("old")).alias("old_no"),
        F.when(F.col("kind") != "del", F.col("new")).alias("new_no"),
        F.when(marked, F.substring("line", 2, 2**30)).otherwise(F.col("line")).alias("text"),
    )


def loose_hunks(diff: Column, least_breaks: int = 3) -> Column:
    """Array of (path, hunk) by the plainer segmenter of local diffs: hunks with fewer line breaks are left out.

    A file starts at ``+++ b/``; a hunk runs from ``@@`` to the next hunk, file or end.
    """
    state = "struct<path:string,open:array<string>,done:array<struct<path:string,hunk:string>>>"
    start = F.struct(F.lit("").alias("path"), F.array().cast("array<string>").alias("open"), F.array().cast("array<struct<path:string,hunk:string>>").alias("done")).cast(state)

    def closed(s: Column) -> Column:
        text_ = F.array_join(s["open"], "\n")
        keep = (F.size(s["open"]) > 0) & (F.size(s["open"]) - 1 >= least_breaks)
        return F.when(keep, F.array_append(s["done"], F.struct(s["path"].alias("path"), text_.alias("hunk")))).otherwise(s["done"])

    def step(s: Column, line: Column) -> Column:
        nothing = F.array().cast("array<string>")
        file_ = F.struct(F.regexp_replace(line, r"^\+\+\+ (?:b/)?", "").alias("path"), nothing.alias("open"), closed(s).alias("done"))
        head = F.struct(s["path"].alias("path"), F.array(line).alias("open"), closed(s).alias("done"))
        other = F.struct(s["path"].alias("path"), nothing.alias("open"), closed(s).alias("done"))
        more = F.struct(s["path"].alias("path"), F.when(F.size(s["open"]) > 0, F.array_append(s["open"], line)).otherwise(s["open"]).alias("open"), s["done"].alias("done"))
        return (
            F.when(line.startswith("+++ "), file_).when(line.startswith("@@"), head)
            .when(line.startswith("diff --git ") | line.startswith("--- "), other).otherwise(more)
        ).cast(state)

    return F.aggregate(F.split(F.regexp_replace(diff, r"\n\z", ""), "\n"), start, step, closed)


def sample_diffs(comments: DataFrame) -> DataFrame:
    """(doc, diff): a diff of two files around each comment's hunk; the first file's kind goes by the delivery number."""
    path, kind = F.coalesce("path", F.lit("unknown")), F.pmod("delivery_id", F.lit(4))
    old = F.when(kind == 1, "/dev/null").when(kind == 3, F.concat(F.lit("a/old/"), path)).otherwise(F.concat(F.lit("a/"), path))
    new = F.when(kind == 2, "/dev/null").otherwise(F.concat(F.lit("b/"), path))
    diff = F.concat(
        F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\nindex 1..2 100644\n--- "), old, F.lit("\n+++ "), new, F.lit("\n"),
        F.coalesce("diff_hunk", F.lit("")),
        F.lit("\ndiff --git a/logo.png b/logo.png\nBinary files a/logo.png and b/logo.png differ\n"),
    )
    return comments.select(F.col("delivery_id").alias("doc"), diff.alias("diff"))


SAMPLE_CTE = r"""
sample as (
  select delivery_id as doc, 'diff --git a/' || p || ' b/' || p || chr(10) || 'index 1..2 100644' || chr(10) || '--- '
    || case delivery_id % 4 when 1 then '/dev/null' when 3 then 'a/old/' || p else 'a/' || p end || chr(10) || '+++ '
    || case delivery_id % 4 when 2 then '/dev/null' else 'b/' || p end || chr(10) || coalesce(diff_hunk, '') || chr(10)
    || 'diff --git a/logo.png b/logo.png' || chr(10) || 'Binary files a/logo.png and b/logo.png differ' as diff
  from (select *, coalesce(path, 'unknown') as p from review_comments)),
split as (select doc, string_split(diff, chr(10)) as parts from sample),
exploded as (select doc, unnest(range(len(parts))) as pos, regexp_replace(unnest(parts), '\r$', '') as line from split),
marked as (
  select *, case when starts_with(line, 'diff --git ') then 'F' when starts_with(line, 'Binary files ') then 'B' when starts_with(line, '--- ') then 'M'
    when starts_with(line, '+++ ') then 'P' when starts_with(line, '@@') then 'H' else 'L' end as mark from exploded),
filed as (select *, (count(*) filter (where mark = 'F') over (partition by doc order by pos)) as f from marked),
lines as (select *, (count(*) filter (where mark = 'H') over (partition by doc, f order by pos)) as h from filed where f > 0)
"""
FILES_SQL = rf"""with {SAMPLE_CTE},
events as (
  select doc, f, pos, regexp_replace(trim(split_part(regexp_replace(line, '^\+\+\+ ', ''), chr(9), 1)), '^[ab]/', '') as new,
    (select regexp_replace(trim(split_part(regexp_replace(max_by(m.line, m.pos), '^--- ', ''), chr(9), 1)), '^[ab]/', '') from lines m
      where m.doc = l.doc and m.f = l.f and m.mark = 'M' and m.pos < l.pos) as old
  from lines l where mark = 'P'),
latest as (select doc, f, max_by(old, pos) as old, max_by(new, pos) as new from events where old is not null group by all),
heads as (
  select doc, f, max(case when mark = 'F' then split_part(line, ' b/', 2) end) as head, bool_or(mark = 'B') as "binary", max(h) as hunks
  from lines group by all)
select doc, f, coalesce(case when new = '/dev/null' then old else new end, head) as path,
  case when old <> '/dev/null' and old <> new then old end as old_path,
  case when old is null then 'modified' when old = '/dev/null' then 'added' when new = '/dev/null' then 'deleted'
    when old <> new then 'renamed' else 'modified' end as status, "binary", hunks
from heads left join latest using (doc, f)"""
NUMBERED_CTE = rf"""{SAMPLE_CTE},
body as (
  select *, case when mark = 'H' then 'head' when line[1] = '+' then 'add' when line[1] = '-' then 'del' when line[1] = '\' then 'note' else 'ctx' end as kind,
    first_value(line) over w as header
  from lines where h > 0 and mark in ('H', 'L') window w as (partition by doc, f, h order by pos)),
starts as (
  select *, coalesce(try_cast(regexp_extract(header, '^@@ -([0-9]+)', 1) as bigint), 0) as old_start,
    coalesce(try_cast(regexp_extract(header, '^@@ -[0-9,]+ \+([0-9]+)', 1) as bigint), 0) as new_start from body),
numbered as (
  select *, case when kind <> 'del' then new_start + (count(*) filter (where kind in ('ctx', 'add')) over w) end as new_no,
    case when kind <> 'add' then old_start + (count(*) filter (where kind in ('ctx', 'del')) over w) end as old_no
  from starts window w as (partition by doc, f, h order by pos rows between unbounded preceding and 1 preceding))
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(sample_diffs(load(spark, sf_dir, "review_comments")), "doc", "diff")


@query(FILES_SQL)
def diff_segment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(_lines(spark, sf_dir)).select("doc", F.col("f").cast("bigint").alias("f"), "path", "old_path", "status", "binary", F.col("hunks").cast("bigint").alias("hunks"))


@query(
    f"""with {NUMBERED_CTE} select doc, f, h, max(header) as header, max(new_start) as new_start, max(old_start) as old_start,
    md5(string_agg(line, chr(10) order by pos)) as raw, coalesce(max(new_no) filter (where kind in ('ctx', 'add')), max(new_start)) as last_new
    from numbered group by all"""
)
def diff_segment_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hunks(_lines(spark, sf_dir)).withColumn("raw", F.md5("raw"))


@query(
    rf"""with {NUMBERED_CTE} select doc, f, h, pos::integer as pos, kind, old_no, new_no, case when line[1] in ('+', '-', ' ') then line[2:] else line end as text
    from numbered where kind in ('ctx', 'add', 'del')"""
)
def diff_segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(_lines(spark, sf_dir))


@query(f"""with {SAMPLE_CTE} select sum(hunks)::bigint as hunks, count(*) as files from (select doc, f, max(h) as hunks from lines group by all)""")
def diff_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files(_lines(spark, sf_dir))
    return found.agg(F.sum("hunks").alias("hunks"), F.count("*").alias("files"))


@query(
    r"""select delivery_id as doc, coalesce(path, 'unknown') as path, md5(diff_hunk) as hunk from review_comments
    where len(string_split(diff_hunk, chr(10))) > 3 and starts_with(diff_hunk, '@@') and not regexp_matches(diff_hunk, '\n(@@|\+\+\+ |--- |diff --git )')"""
)
def diff_loose_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plainer segmenter; the sample's second file has no hunk."""
    found = sample_diffs(load(spark, sf_dir, "review_comments").where("diff_hunk is not null"))
    simple = found.withColumn("diff", F.regexp_replace("diff", r"\+\+\+ /dev/null", "+++ b/gone"))
    rows = simple.select("doc", F.inline(loose_hunks(F.col("diff"))))
    named = rows.join(load(spark, sf_dir, "review_comments").select(F.col("delivery_id").alias("doc"), F.col("path").alias("own")), "doc")
    return named.select("doc", F.coalesce("own", F.lit("unknown")).alias("path"), F.md5("hunk").alias("hunk"))
