"""Queries for the scalar functions that no table exercises by itself: inline fixtures beside the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill.functions import duck, text
from hunkmill.functions import vectors as V
from hunkmill.operators import critics, examples
from hunkmill.operators.components import components
from hunkmill.registry import query
from hunkmill.sources import models
from hunkmill.workspace import load


def _values(rows: list[tuple], *names: str) -> str:
    def literal(v: object) -> str:
        return "null" if v is None else duck.quoted(v) if isinstance(v, str) else str(v)

    return f"(values {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) t({', '.join(names)})"


LINKS = [
    (1, '<https://x/p?page=2>; rel="next", <https://x/p?page=9>; rel="last"'),
    (2, '<https://x/p?page=1>; rel="prev", <https://x/p?page=3>; rel="next"'),
    (3, '<https://x/p?page=1>; rel="prev"'),
    (4, '<https://x/p?page=4>; title="t"; rel="next"'),
    (5, ""),
    (6, None),
]


@query(
    rf"""select k, nullif(regexp_extract(h, '<([^>]*)>[^,]*rel="next"', 1), '') as loose, nullif(regexp_extract(h, '<([^>]*)>\s*;\s*rel="next"', 1), '') as strict
    from {_values(LINKS, "k", "h")}"""
)
def link_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(LINKS, "k int, h string")
    return rows.select("k", text.next_link(F.col("h")).alias("loose"), text.next_link_strict(F.col("h")).alias("strict"))


REPLIES = [
    (1, "REJECT\nThe lock is held."), (2, "ACCEPT, though one could reject it"), (3, "no keyword"), (4, "UNACCEPTABLE"), (5, "unsure"), (6, ""), (7, "Accept - fine"),
]


@query(
    f"""with p as (select *, {", ".join(f"coalesce(nullif(instr(upper(s), '{w}'), 0), 1000000) as {w[0].lower()}" for w in text.VERDICTS)} from {_values(REPLIES, "k", "s")})
    select k, case when least(a, r, u) = 1000000 then 'unsure' when a < r and a < u then 'accept' when r < u then 'reject' else 'unsure' end as verdict,
      nullif({duck.trim('s')}, '') as reason, regexp_replace({duck.trim_start('s')}, '^(?:ACCEPT|REJECT|UNSURE|Accept|Reject|Unsure)[:., \\n\\r-]*', '') as stripped from p"""
)
def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, s = spark.createDataFrame(REPLIES, "k int, s string"), F.col("s")
    return rows.select("k", text.parse_verdict(s).alias("verdict"), text.verdict_reason(s).alias("reason"), text.strip_verdict(s).alias("stripped"))


ANSWERS = [
    (1, '{"choices":[{"message":{"role":"assistant","content":" Looks off. "}}]}'),
    (2, '{"choices":[{"message":{"role":"assistant","content":"  ","reasoning_content":"thinking"}}]}'),
    (3, '{"choices":[]}'),
    (4, '{"choices":[{"message":{"role":"assistant","content":null,"reasoning_content":"because"}}]}'),
    (5, '{"choices":[{"message":{"content":"   "}}]}'),
]


@query(
    rf"""select k, coalesce(nullif(trim(json_extract_string(a, '$.choices[0].message.content')), ''), nullif(trim(json_extract_string(a, '$.choices[0].message.reasoning_content')), '')) as lenient,
    case when not regexp_matches(a, '"content"\s*:\s*null') then
      coalesce(nullif(trim(json_extract_string(a, '$.choices[0].message.content')), ''), nullif(trim(json_extract_string(a, '$.choices[0].message.reasoning_content')), '')) end as strict
    from {_values(ANSWERS, "k", "a")}"""
)
def completion_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, a = spark.createDataFrame(ANSWERS, "k int, a string"), F.col("a")
    return rows.select("k", critics.completion_text(a).alias("lenient"), critics.completion_text(a, strict=True).alias("strict"))


CONFIGS = [
    (1, '{"hidden_size": 64, "num_hidden_layers": 8, "rope_theta": 5000.0}'),
    (2, '{"hidden_size": 1, "text_config": {"hidden_size": 32, "num_hidden_layers": 12, "full_attention_interval": 3, "rope_parameters": {"rope_theta": 100.0, "partial_rotary_factor": 0.5}}}'),
    (3, "{}"),
]


@query(
    f"""select k, coalesce((c->>'$.text_config.hidden_size')::integer, (c->>'$.hidden_size')::integer) as hidden, coalesce((c->>'$.text_config.full_attention_interval')::integer, 4) as "interval",
    coalesce((c->>'$.text_config.rope_parameters.rope_theta')::double, (c->>'$.rope_theta')::double, 10000000::double) as theta,
    coalesce((c->>'$.text_config.rope_parameters.partial_rotary_factor')::double, 0.25::double) as rotary from {_values(CONFIGS, "k", "c")}"""
)
def model_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = models.config(F.col("c"))
    rows = spark.createDataFrame(CONFIGS, "k int, c string")
    return rows.select("k", c["hidden_size"].alias("hidden"), c["full_attention_interval"].alias("interval"), c["rope_theta"].alias("theta"), c["partial_rotary_factor"].alias("rotary"))


@query("select i::integer as layer, (i + 1) % 4 = 0 as full_attention from range(32) r(i)")
def layer_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(32).select(F.col("id").cast("int").alias("layer"), models.is_full_attention(F.col("id"), F.lit(4)).alias("full_attention"))


WEIGHTS = [
    "model.layers.0.self_attn.q_proj.weight", "model.layers.0.mlp.up_proj.weight", "model.layers.0.input_layernorm.weight", "lm_head.weight",
    "model.layers.1.linear_attn.out_proj.weight", "model.layers.1.self_attn.q_norm.weight", "model.visual.layers.0.q_proj.bias",
]


@query(
    rf"""with n as (select * from {_values([(w,) for w in WEIGHTS], "name")})
    select name, starts_with(name, 'model.') and ends_with(name, '.weight') and regexp_matches(name, '\.layers\.[0-9]+\..*(q|k|v|o|gate|up|down|out)_proj\.weight$') as adapted,
      'base_model.model.' || regexp_replace(name, '\.weight$', '') || '.lora_A.weight' as key_a from n"""
)
def adapter_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = spark.createDataFrame([(w,) for w in WEIGHTS], "name string"), F.col("name")
    return rows.select("name", models.adapted(name).alias("adapted"), models.adapter_keys(name)[0].alias("key_a"))


SPECS = [("epoch1=/a/b",), ("/plain/path",), ("x=a=b",)]
HEADERS = [("a/src/lib.rs\t2024-01-01",), ("b/README.md",), ("/dev/null",), ("src/x.rs",)]


@query(f"select s, case when contains(s, '=') then split_part(s, '=', 1) else 'default' end as name, regexp_replace(s, '^[^=]*=', '') as path from {_values(SPECS, 's')}")
def adapter_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(SPECS, "s string")
    return rows.select("s", text.adapter_name(F.col("s")).alias("name"), text.adapter_path(F.col("s")).alias("path"))


@query(f"select p, regexp_replace(split_part(p, chr(9), 1), '^[ab]/', '') as path from {_values(HEADERS, 'p')}")
def header_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(HEADERS, "p string").select("p", text.strip_ab_prefix(F.col("p")).alias("path"))


@query(
    """select repo, number, replace(repo, '/', '_') || '-' || number || '-' || strftime(fetched_at, '%Y%m%dT%H%M%S') as session,
    regexp_replace(html_url || '///', '/+$', '') as url from pr_meta"""
)
def session_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "pr_meta")
    return rows.select(
        "repo", "number", text.session_id(F.col("repo"), F.col("number"), F.col("fetched_at")).alias("session"),
        text.trim_slash(F.concat("html_url", F.lit("///"))).alias("url"),
    )


@query(f"select finding_id, session_id, md5({duck.quoted('File: ')} || path || chr(10) || chr(10) || '```diff' || chr(10) || {duck.trim_end('hunk_raw')} || chr(10) || '```' || chr(10) || chr(10) || 'The reviewer''s comment on this hunk:' || chr(10) || {duck.trim('critic_comment')}) as prompt from critic_findings")
def judge_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = text.judge_prompt(F.col("path"), F.col("hunk_raw"), F.col("critic_comment"))
    return load(spark, sf_dir, "critic_findings").select("finding_id", "session_id", F.md5(p).alias("prompt"))


@query(
    """select finding_id, session_id, json_extract_string(b, '$.messages[1].content') = prompt as same, json_extract_string(b, '$.messages[0].role') as role,
      (b->>'$.max_tokens')::integer as max_tokens, (b->>'$.stream')::boolean as stream
    from (select *, json_object('messages', json_array(json_object('role', 'system', 'content', 's'), json_object('role', 'user', 'content', prompt)), 'max_tokens', 512, 'stream', false) as b from critic_findings)"""
)
def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request as JSON, read back."""
    b = critics.request_column("m", text.SYSTEM, F.col("prompt"), 0.2, 512)
    rows = load(spark, sf_dir, "critic_findings").withColumn("b", b)
    get = F.get_json_object
    return rows.select(
        "finding_id", "session_id", (get("b", "$.messages[1].content") == F.col("prompt")).alias("same"), get("b", "$.messages[0].role").alias("role"),
        get("b", "$.max_tokens").cast("int").alias("max_tokens"), get("b", "$.stream").cast("boolean").alias("stream"),
    )


@query("select record_id, len(messages) as n, messages[len(messages)].role as last, meta.repo as repo, meta.reply_count as replies from chat_records")
def chat_record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows to JSON and back."""
    from hunkmill.schemas import CHAT_RECORD

    rows = load(spark, sf_dir, "chat_records").select("record_id", F.to_json(F.struct("messages", "meta")).alias("j"))
    back = rows.select("record_id", F.from_json("j", CHAT_RECORD, {"mode": "FAILFAST"}).alias("r"))
    return back.select(
        "record_id", F.size("r.messages").cast("bigint").alias("n"), F.element_at("r.messages", -1)["role"].alias("last"), "r.meta.repo", F.col("r.meta.reply_count").alias("replies")
    )


@query(
    """with m as (select vec_id, list_transform(embedding, lambda x: (x > 0)::integer) as mask from embeddings)
    select vec_id, array_to_string(list_transform(mask, lambda x, i: (list_sum(mask[1:i]) - 1)::integer), ',') as places from m"""
)
def running_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each number among the positive ones so far."""
    mask = F.transform("embedding", lambda x: F.when(x > 0, 1).otherwise(0))
    rows = load(spark, sf_dir, "embeddings").select("vec_id", mask.alias("mask"))
    return rows.select("vec_id", F.array_join(examples.positions_of(F.col("mask")).cast("array<string>"), ",").alias("places"))


@query(
    """with w as (select record_id, len(list_filter(regexp_split_to_array(messages[len(messages)].content, '\\s+'), lambda x: x <> '')) as n from chat_records),
    t as (select max(n) as width from w) select record_id, n, width - n as pad, width from w, t"""
)
def left_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padding of each row to the longest of the batch."""
    last = F.element_at("messages", -1)["content"]
    n = F.size(F.filter(F.split(last, r"\s+"), lambda x: x != "")).cast("bigint")
    rows = load(spark, sf_dir, "chat_records").select("record_id", n.alias("n"))
    width = rows.agg(F.max("n").alias("w")).first().w or 0
    return rows.select("record_id", "n", (F.lit(width) - F.col("n")).alias("pad"), F.lit(width).cast("bigint").alias("width"))


@query("select vec_id, round(embedding[1]::double, 6) as a, round(embedding[8]::double, 6) as b, round(embedding[3]::double, 6) as c from embeddings")
def gather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = V.gather(V.wide(F.col("embedding")), F.array(F.lit(0), F.lit(7), F.lit(2)))
    return load(spark, sf_dir, "embeddings").select("vec_id", *(F.round(got[i], 6).alias(x) for i, x in enumerate("abc")))


@query("select vec_id, " + ", ".join(f"round(embedding[{i // 2 + 1}]::double, 6) as v_{i}" for i in range(6)) + " from embeddings")
def repeat_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = V.repeat_each(F.slice(F.transform("embedding", lambda x: F.round(x.cast("double"), 6)), 1, 3), 2)
    return load(spark, sf_dir, "embeddings").select("vec_id", v.alias("v")).select("vec_id", *(F.col("v")[i].alias(f"v_{i}") for i in range(6)))


@query("select doc_id, n_chars from documents order by n_chars desc nulls last, doc_id limit 20")
def longest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the twenty longest; the limit is the feature."""
    return load(spark, sf_dir, "documents").orderBy(F.desc_nulls_last("n_chars"), "doc_id").limit(20).select("doc_id", "n_chars")


def shuffle_key(key: Column, epoch: int, seed: int = 0) -> Column:
    """What the rows of an epoch are ordered by: a hash that differs by epoch and can be repeated, then the key."""
    return F.struct(F.md5(F.concat_ws("-", key.cast("string"), F.lit(seed), F.lit(epoch))).alias("h"), key.alias("k"))


def shuffled(rows: DataFrame, key: str, epoch: int, seed: int = 0) -> DataFrame:
    """Rows in an order that differs by epoch and can be repeated."""
    return rows.orderBy(shuffle_key(F.col(key), epoch, seed))


@query(
    """select epoch, doc_id, row_number() over (partition by epoch order by md5(doc_id || '-0-' || epoch), doc_id) as place
    from documents, (values (1), (2)) e(epoch)"""
)
def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in two epochs."""
    from hunkmill.operators.findings import number_rows

    rows = load(spark, sf_dir, "documents").select("doc_id")
    numbered = [number_rows(rows.withColumn("order", shuffle_key(F.col("doc_id"), e)), "order", "place").select(F.lit(e).alias("epoch"), "doc_id", "place") for e in (1, 2)]
    return numbered[0].unionByName(numbered[1])


def touched_later(flags: DataFrame, changes: DataFrame, reach: int = 0) -> DataFrame:
    """Flags (flag, repo, path, line, at) whose line a later change (repo, path, first, last, at) touched.

    A change's lines are taken apart into blocks of 1, 2, 4, ... lines that begin at multiples of their size, two
    of each size at most, and of all changes of a block only the latest matters; it combines on the map side.  A
    line lies in one block of each size.  So a change of any length gives few rows, and neither a file with very many changes
    nor a line with very many flags brings flags and changes together in pairs.
    """
    spans = changes.where("first <= last").select("repo", "path", (F.col("first") - reach).alias("first"), (F.col("last") + reach).alias("last"), "at")
    longest = spans.agg(F.max(F.col("last") - F.col("first") + 1).alias("n")).first().n or 1
    sizes = range(int(longest).bit_length())
    blocks = []
    for k in sizes:
        low, high = F.shiftright(F.col("first") + (2**k - 1), k), F.shiftright(F.col("last") + 1, k) - 1
        blocks.append(F.when((low <= high) & (low.bitwiseAND(F.lit(1)) == 1), F.struct(F.lit(k).alias("size"), low.alias("block"))))
        blocks.append(F.when((low <= high) & (high.bitwiseAND(F.lit(1)) == 0), F.struct(F.lit(k).alias("size"), high.alias("block"))))
    parts = spans.select("repo", "path", "at", F.explode(F.array_compact(F.array(*blocks))).alias("b"))
    latest = parts.groupBy("repo", "path", "b.size", "b.block").agg(F.max("at").alias("changed"))
    lines = flags.where("line is not null").select("repo", "path", F.col("line").cast("bigint").alias("line")).distinct()
    around = F.explode(F.array(*[F.struct(F.lit(k).alias("size"), F.shiftright("line", k).alias("block")) for k in sizes])).alias("b")
    met = lines.select("repo", "path", "line", around).select("repo", "path", "line", "b.*").join(latest, ["repo", "path", "size", "block"])
    last = met.groupBy("repo", "path", "line").agg(F.max("changed").alias("changed"))
    return flags.join(last, ["repo", "path", "line"]).where(F.col("changed") > F.col("at")).select("flag").distinct()


@query(
    rf"""with c as (select delivery_id, {duck.repo_of('pull_request_url')} as repo, path, line, try_cast(created_at as timestamptz) as made,
      coalesce(try_cast(regexp_extract(diff_hunk, '\+([0-9]+)', 1) as bigint), 0) as first, diff_hunk from review_comments),
    spans as (select repo, path, made as changed, first, first + 10 as last from c where path is not null and diff_hunk is not null)
    select distinct r.delivery_id as flag from c r join spans s on s.repo = r.repo and s.path = r.path and s.changed > r.made and r.line between s.first and s.last"""
)
def acted_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments whose line a later hunk of the same file of the same repository reaches; hunks stand in for commits."""
    rows = load(spark, sf_dir, "review_comments").select(
        "delivery_id", text.repo_of(F.col("pull_request_url")).alias("repo"), "path", "line", F.try_to_timestamp("created_at").alias("at"), "diff_hunk"
    )
    start = F.coalesce(F.regexp_extract("diff_hunk", r"\+([0-9]+)", 1).try_cast("bigint"), F.lit(0))
    spans = rows.where("path is not null and diff_hunk is not null").select("repo", "path", start.alias("first"), (start + 10).alias("last"), "at")
    return touched_later(rows.withColumnRenamed("delivery_id", "flag"), spans)


def relabel(records: DataFrame, scores: DataFrame) -> DataFrame:
    """Chat records with the scores (source_id, score) of a judge in place of their own; the others keep theirs."""
    best = scores.groupBy("source_id").agg(F.max("score").alias("_score"))
    joined = records.withColumn("source_id", F.col("meta.source_id")).join(best, "source_id", "left")
    score = F.coalesce(F.col("_score").cast("float"), F.col("meta.design_score"))
    return joined.withColumn("meta", F.col("meta").withField("design_score", score)).drop("source_id", "_score")


@query("select record_id, round((case when meta.source_id % 3 = 0 then 0.5 else meta.design_score end)::double, 5) as score from chat_records")
def relabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = load(spark, sf_dir, "chat_records")
    scores = records.select(F.col("meta.source_id").alias("source_id"), F.lit(0.5).alias("score")).where("source_id % 3 = 0")
    return relabel(records, scores).select("record_id", F.round(F.col("meta.design_score").cast("double"), 5).alias("score"))


def related_concerns(findings: DataFrame, least: float = 0.5) -> DataFrame:
    """(repo, pr, a, b, jaccard): findings of one pull request on different files whose word sets overlap at least so much.

    Sets of n and m words that overlap so much share one of the first ``n - ceil(least x n) + 1`` words of either in any
    common order.  In the order of how seldom a pull request uses them, those are seldom common words, so only
    findings that may be related meet; each pair is then measured.
    """
    words = F.array_distinct(F.filter(F.split(F.lower("critic_comment"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    key = ["repo", "pr", "path", "finding_id"]
    sets = findings.select(*key, words.alias("words")).groupBy(*key).agg(F.first("words").alias("words"))
    flat = sets.select(*key, F.size("words").alias("n"), F.explode("words").alias("word"))
    often = flat.groupBy("repo", "pr", "word").agg(F.count("*").alias("often"))
    place = F.row_number().over(W.partitionBy(*key).orderBy("often", "word"))
    first = flat.join(often, ["repo", "pr", "word"]).withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1)
    a, b = (first.select("repo", "pr", "word", *(F.col(c).alias(f"{c}_{s}") for c in ("path", "finding_id", "n"))) for s in "ab")
    near = a.join(b, ["repo", "pr", "word"]).where("finding_id_a < finding_id_b and path_a <> path_b")
    near = near.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least) - 1e-9).select("repo", "pr", "path_a", "finding_id_a", "path_b", "finding_id_b").distinct()
    left, right = (sets.select("repo", "pr", *(F.col(c).alias(f"{c}_{s}") for c in ("path", "finding_id", "words"))) for s in "ab")
    both = near.join(left, ["repo", "pr", "path_a", "finding_id_a"]).join(right, ["repo", "pr", "path_b", "finding_id_b"])
    shared = F.size(F.array_intersect("words_a", "words_b"))
    score = shared / (F.size("words_a") + F.size("words_b") - shared)
    return both.where(score >= least).select("repo", "pr", F.col("finding_id_a").alias("a"), F.col("finding_id_b").alias("b"), F.round(score, 6).alias("jaccard"))


def concern_groups_of(findings: DataFrame, least: float = 0.5) -> DataFrame:
    """(repo, pr, finding_id, concern): findings that related pairs tie together have one concern, its smallest finding."""
    pairs = related_concerns(findings, least).select("repo", "pr", F.col("a").alias("u"), F.col("b").alias("v"))
    tied = components(pairs, "repo", "pr").select("repo", "pr", F.col("node").alias("finding_id"), "root")
    rows = findings.select("repo", "pr", "finding_id").distinct().join(tied, ["repo", "pr", "finding_id"], "left")
    return rows.select("repo", "pr", "finding_id", F.coalesce("root", "finding_id").alias("concern"))


RELATED_SQL = """w as (select distinct repo, pr, path, finding_id, list_distinct(list_filter(regexp_split_to_array(lower(critic_comment), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) as w from critic_findings),
    p as (select a.repo, a.pr, a.finding_id as a, b.finding_id as b, len(list_intersect(a.w, b.w)) as k, len(a.w) + len(b.w) as n from w a join w b on a.repo = b.repo and a.pr = b.pr
      and a.finding_id < b.finding_id and a.path <> b.path)"""


@query(f"with {RELATED_SQL} select repo, pr, a, b, round(k / (n - k)::double, 6) as jaccard from p where k / (n - k)::double >= 0.1")
def concern_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related pairs; :func:`concern_groups` has the clusters they form."""
    return related_concerns(load(spark, sf_dir, "critic_findings"), 0.1)


@query(
    f"""with recursive {RELATED_SQL}, e as (select repo, pr, a as u, b as v from p where k / (n - k)::double >= 0.1 union select repo, pr, b, a from p where k / (n - k)::double >= 0.1),
    r as (select distinct repo, pr, finding_id as u, finding_id as v from critic_findings union select r.repo, r.pr, r.u, e.v from r join e on e.repo = r.repo and e.pr = r.pr and e.u = r.v)
    select repo, pr, u as finding_id, min(v) as concern from r group by all"""
)
def concern_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concern of every finding."""
    return concern_groups_of(load(spark, sf_dir, "critic_findings"), 0.1)


@query(
    """select repo, pr, count(*) as comments, count(distinct i.user.login) as people, max(created_at) as last from issue_comments i group by 1, 2"""
)
def discussion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "issue_comments")
    return rows.groupBy("repo", "pr").agg(F.count("*").alias("comments"), F.countDistinct("user.login").alias("people"), F.max("created_at").alias("last"))


@query(
    """select m.repo, m.number, count(distinct c.delivery_id) as inline, (select count(*) from issue_comments i where i.repo = m.repo and i.pr = m.number) as discussion
    from (select distinct repo, number from pr_meta) m left join review_comments c on regexp_extract(c.pull_request_url, '/repos/([^/]*/[^/]*)', 1) = m.repo
      and regexp_matches(c.pull_request_url, '/' || m.number || '$') group by 1, 2"""
)
def pr_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull request's header with the numbers of its inline and general comments; both sides are aggregated before they meet."""
    url = F.col("pull_request_url")
    prs = load(spark, sf_dir, "pr_meta").select("repo", "number").distinct()
    inline = load(spark, sf_dir, "review_comments").select(text.repo_of(url).alias("repo"), text.pr_number(url).alias("number"))
    inline = inline.where("number is not null").groupBy("repo", "number").agg(F.count("*").alias("inline"))
    talk = load(spark, sf_dir, "issue_comments").groupBy("repo", F.col("pr").alias("number")).agg(F.count("*").alias("discussion"))
    zero = F.lit(0).cast("bigint")
    return prs.join(inline, ["repo", "number"], "left").join(talk, ["repo", "number"], "left").select("repo", "number", F.coalesce("inline", zero).alias("inline"), F.coalesce("discussion", zero).alias("discussion"))


def row_numbers(rows: DataFrame, by: str, order: Column) -> DataFrame:
    """With ``place`` by a plain window; for groups that are known to be small."""
    return rows.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(order)))
