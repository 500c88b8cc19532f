"""Training examples: masked token rows, truncation, losses, splits by time, batches of like length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill.functions import duck, text
from hunkmill.registry import query
from hunkmill.workspace import load

END = "<|im_end|>"


def first_message(messages: Column, role: str) -> Column:
    """Content of the first message with a role; null if there is none."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"]


def turns(records: DataFrame, system: str = text.SYSTEM) -> DataFrame:
    """With ``prompt`` and ``completion`` texts; records without user or assistant are left out, a missing system is the constant."""
    m = F.col("messages")
    user, answer = first_message(m, "user"), first_message(m, "assistant")
    rows = records.where(user.isNotNull() & answer.isNotNull())
    prompt = text.render_prompt(F.coalesce(first_message(m, "system"), F.lit(system)), user)
    return rows.withColumns({"prompt": prompt, "completion": F.concat(answer, F.lit(END))})


def fit(prompt: Column, completion: Column, max_seq: int) -> Column:
    """struct(ids, prompt_len) with the prompt's front cut so that both fit; null if the completion alone doesn't."""
    drop = F.greatest(F.size(prompt) + F.size(completion) - max_seq, F.lit(0))
    kept = F.slice(prompt, drop + 1, F.greatest(F.size(prompt) - drop, F.lit(0)))
    fits = (F.size(completion) > 0) & ((drop == 0) | (drop < F.size(prompt)))
    return F.when(fits, F.struct(F.concat(kept, completion).alias("ids"), F.size(kept).alias("prompt_len")))


def supervised_positions(ids: Column, prompt_len: Column) -> Column:
    """Positions whose next token is part of the completion."""
    first, last = F.greatest(prompt_len - 1, F.lit(0)), F.size(ids) - 2
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def masked_nll(log_probs: Column, positions: Column) -> Column:
    """Mean negative log-probability over the positions (from 0)."""
    losses = F.transform(positions, lambda t: -F.element_at(log_probs, t + 1))
    return F.aggregate(losses, F.lit(0.0), lambda a, x: a + x) / F.size(losses)


def pad_left(ids: Column, width: Column, pad: int = 0) -> Column:
    return F.concat(F.array_repeat(F.lit(pad), (width - F.size(ids)).cast("int")), ids)


def positions_of(mask: Column) -> Column:
    """Position of each token among the real ones: the running sum of the mask less one.

    A sum that runs along an array is linear only outside column expressions, so this is an Arrow batch function.
    """
    def places(masks: pd.Series) -> pd.Series:
        return masks.map(lambda m: None if m is None else np.cumsum(np.asarray(m, np.int32), dtype=np.int32) - 1)

    return F.pandas_udf(places, "array<int>")(mask)  # type: ignore[call-overload]


#: Widths of time, in microseconds, by which an instant is narrowed down: day, hour, second, millisecond, itself.
NARROWING = (86_400_000_000, 3_600_000_000, 1_000_000, 1_000, 1)


def quantile_instant(rows: DataFrame, us: Column, share: float) -> int | None:
    """The smallest instant (microseconds) up to which at least the share of all rows lies; exact.

    Counts per day, then per hour of the day in which the share falls, and so on: no sort, and a level
    brings at most a few thousand counts to the driver, the first one as many as there are days.
    """
    inside = rows.select(us.alias("us")).where("us is not null")
    wanted: float | None = None
    before, at = 0, None
    for width in NARROWING:
        level = inside if at is None else inside.where((F.col("us") >= at[0]) & (F.col("us") < at[1]))
        counts = sorted((r.b, r.n) for r in level.groupBy(F.floor(F.col("us") / width).alias("b")).agg(F.count("*").alias("n")).collect())
        if not counts:
            return None
        wanted = share * sum(n for _, n in counts) if wanted is None else wanted
        for bucket, n in counts:
            if before + n >= wanted:
                break
            before += n
        at = (bucket * width, (bucket + 1) * width)
    return at[0]


def hold_out_recent(rows: DataFrame, at: str, share: float) -> DataFrame:
    """With ``split``: the most recent share of rows, by a cut in time, is held out.

    Rows at the cut's instant go to training together, and so do rows without a time.
    """
    us = F.unix_micros(F.col(at).cast("timestamp"))
    cut = quantile_instant(rows, us, 1 - share)
    late = us > F.lit(cut) if cut is not None else F.lit(False)
    return rows.withColumn("split", F.when(late, "holdout").otherwise("train"))


def length_batches(rows: DataFrame, key: str, length: str, size: int, accumulate: int, seed: int = 1) -> DataFrame:
    """(key, length, mega, slot): hash-shuffled rows in megabatches, by falling length within each.

    The shuffle is the order of a seeded hash, numbered in parallel.
    """
    from hunkmill.operators.findings import number_rows

    hashed = rows.select(key, length, F.struct(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(seed))).alias("h"), F.col(key).alias("k")).alias("order"))
    numbered = number_rows(hashed, "order", "n")
    mega = F.floor((F.col("n") - 1) / (size * accumulate)).alias("mega")
    place = F.row_number().over(W.partitionBy("mega").orderBy(F.desc_nulls_last(length), "order"))
    return numbered.select(key, length, "order", mega).withColumn("slot", place).drop("order")


WORDS = r"\S+"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(load(spark, sf_dir, "chat_records"))
    return rows.select("record_id", *(F.filter(F.split(c, r"[ \n\r\t]+"), lambda w: w != "").alias(c) for c in ("prompt", "completion")))


MESSAGE_SQL = """firsts as (select record_id, list_filter(messages, lambda m: m.role = '{0}')[1].content as {0} from chat_records)"""
TURNS_CTE = f"""
picked as (select record_id, list_filter(messages, lambda m: m.role = 'system')[1].content as s, list_filter(messages, lambda m: m.role = 'user')[1].content as u,
    list_filter(messages, lambda m: m.role = 'assistant')[1].content as a from chat_records),
turns as (select record_id, '<|im_start|>system' || chr(10) || {duck.trim(f"coalesce(s, {duck.quoted(text.SYSTEM)})")} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
    || {duck.trim("u")} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) as prompt,
    a || '<|im_end|>' as completion from picked where u is not null and a is not null),
words as (select record_id, list_filter(regexp_split_to_array(prompt, '[ \\n\\r\\t]+'), lambda w: w <> '') as p,
    list_filter(regexp_split_to_array(completion, '[ \\n\\r\\t]+'), lambda w: w <> '') as c from turns)
"""
MAX_SEQ = 96


@query(f"with {TURNS_CTE} select record_id, md5(prompt) as prompt, md5(completion) as completion from turns")
def chat_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(load(spark, sf_dir, "chat_records"))
    return rows.select("record_id", F.md5("prompt").alias("prompt"), F.md5("completion").alias("completion"))


@query(
    f"""with {TURNS_CTE}, sized as (select *, greatest(len(p) + len(c) - {MAX_SEQ}, 0) as drop from words)
    select record_id, (len(p) - drop)::integer as prompt_len, (len(p) - drop + len(c))::integer as n, md5(array_to_string(p[drop + 1:] || c, ' ')) as ids
    from sized where len(c) > 0 and (drop = 0 or drop < len(p))"""
)
def sft_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word tokens stand in for a model's; ``hunkmill.sources.tokenizer`` has the real ones."""
    rows = _words(spark, sf_dir).withColumn("x", fit(F.col("prompt"), F.col("completion"), MAX_SEQ)).where("x is not null")
    return rows.select("record_id", "x.prompt_len", F.size("x.ids").alias("n"), F.md5(F.array_join("x.ids", " ")).alias("ids"))


@query(
    f"""with {TURNS_CTE} select record_id, greatest(len(p) - 1, 0)::integer as first, (len(p) + len(c) - 2)::integer as last,
    greatest(len(p) + len(c) - 1 - greatest(len(p) - 1, 0), 0)::integer as n from words where len(p) + len(c) - 2 >= greatest(len(p) - 1, 0)"""
)
def sft_supervised_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _words(spark, sf_dir).select("record_id", supervised_positions(F.concat("prompt", "completion"), F.size("prompt")).alias("at"))
    return rows.where(F.size("at") > 0).select("record_id", F.element_at("at", 1).alias("first"), F.element_at("at", -1).alias("last"), F.size("at").alias("n"))


@query(
    """with l as (select vec_id, list_transform(embedding, lambda x: -abs(x::double)) as lp from embeddings)
    select vec_id, round(list_avg(list_transform(lp[11:], lambda x: -x)), 6) as nll from l"""
)
def masked_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: -F.abs(x.cast("double"))).alias("lp"))
    at = F.sequence(F.lit(10), F.size("lp") - 1)
    return rows.select("vec_id", F.round(masked_nll(F.col("lp"), at), 6).alias("nll"))


@query(
    """with per as (select fetched_at, count(*) as n from pr_meta where fetched_at is not null group by 1),
    run as (select fetched_at, sum(n) over (order by fetched_at) as upto, sum(n) over () as total from per),
    cut as (select min(fetched_at) as top from run where upto >= total * 0.9)
    select repo, number, fetched_at, case when fetched_at > top then 'holdout' else 'train' end as split from pr_meta, cut"""
)
def recent_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hold_out_recent(load(spark, sf_dir, "pr_meta").select("repo", "number", "fetched_at"), "fetched_at", 0.1)


@query(
    """with n as (select doc_id, n_chars, row_number() over (order by md5(doc_id || '-1'), doc_id) as n from documents), m as (select *, (n - 1) // 32 as mega from n)
    select doc_id, n_chars, mega, (row_number() over (partition by mega order by n_chars desc nulls last, n))::integer as slot from m"""
)
def length_group_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_batches(load(spark, sf_dir, "documents"), "doc_id", "n_chars", 8, 4)


@query(
    """select record_id, len(list_filter(messages, lambda m: m.role = 'system')) as systems, len(messages) as n from chat_records
    where len(list_filter(messages, lambda m: m.role = 'assistant')) = 0 or len(list_filter(messages, lambda m: m.role = 'user')) = 0"""
)
def skipped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("messages")
    lacks = first_message(m, "user").isNull() | first_message(m, "assistant").isNull()
    systems = F.size(F.filter(m, lambda x: x["role"] == "system")).cast("bigint")
    return load(spark, sf_dir, "chat_records").where(lacks).select("record_id", systems.alias("systems"), F.size(m).cast("bigint").alias("n"))


@query(
    rf"""select comment_id, regexp_replace(regexp_replace(body, '(?s)~~.*?~~|<s>.*?</s>', '', 'g'), '(?i)\n*edit:\s*never ?mind.*$', '') as body from issue_comments"""
)
def strike_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struck-out passages and withdrawn remarks removed."""
    body = F.regexp_replace("body", r"(?s)~~.*?~~|<s>.*?</s>", "")
    return load(spark, sf_dir, "issue_comments").select("comment_id", F.regexp_replace(body, r"(?i)\n*edit:\s*never ?mind.*$", "").alias("body"))


# The settings of the supervised training run.
TRAINING = {
    "learning_rate_schedule": "cosine", "warmup_share": 0.03, "gradient_accumulation": 32, "batch": 1, "epochs": 3, "assistant_only_loss": True,
    "packing": False, "evaluate_every": 100, "save_every": 200, "saves_kept": 3, "log_every": 10, "adapter_dropout": 0.05, "alpha_of_rank": 2,
}


def training_plan(records: DataFrame, settings: dict | None = None) -> DataFrame:
    """(rows, steps, warmup_steps, evaluations, saves) of a run over the records, by the settings."""
    s = TRAINING | (settings or {})
    per_step = s["batch"] * s["gradient_accumulation"]
    counted = records.agg(F.count("*").alias("rows")).withColumn("steps", F.ceil(F.col("rows") / per_step) * s["epochs"])
    return counted.select(
        "rows", "steps", F.ceil(F.col("steps") * F.lit(s["warmup_share"])).alias("warmup_steps"),
        F.floor(F.col("steps") / s["evaluate_every"]).alias("evaluations"), F.floor(F.col("steps") / s["save_every"]).alias("saves"),
    )


def learning_rate_share(step: Column, steps: Column, warmup: Column) -> Column:
    """The part of the highest learning rate at a step from 0: up in a line, then down along half a cosine."""
    rising = step / F.greatest(warmup, F.lit(1))
    falling = (F.cos((step - warmup) / F.greatest(steps - warmup, F.lit(1)) * F.pi()) + 1) / 2
    return F.when(step < warmup, rising).otherwise(falling)


@query(
    """with n as (select count(*) as rows from chat_records), s as (select rows, (ceil(rows / 32) * 3)::bigint as steps from n), w as (select *, ceil(steps * 0.03::double)::bigint as warm from s)
    select rows, steps, warm as warmup_steps, steps // 100 as evaluations, steps // 200 as saves, k as step,
      round(case when k < warm then k / greatest(warm, 1) else (cos((k - warm) / greatest(steps - warm, 1) * pi()) + 1) / 2 end, 9) as share from w, unnest(range(0, steps)) r(k)"""
)
def training_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of a run over all chat records, and each step's part of the learning rate."""
    plan = training_plan(load(spark, sf_dir, "chat_records"))
    step = plan.where("steps > 0").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("steps") - 1)).alias("step"))
    return step.withColumn("share", F.round(learning_rate_share(F.col("step"), F.col("steps"), F.col("warmup_steps")), 9))
