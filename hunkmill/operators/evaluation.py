"""Comparing results: differences, agreement, losses over steps, throughput, and queries on vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill.functions import vectors as V
from hunkmill.registry import query
from hunkmill.workspace import load


def compare(got: DataFrame, expected: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """One row (n, missing, max_abs, mean_abs, within): arrays of numbers compared element by element.

    Arrays of other lengths and keys on one side only count as missing.
    """
    both = got.select(*keys, F.col(value).alias("_a")).join(expected.select(*keys, F.col(value).alias("_b")), keys, "full_outer")
    pairs = F.zip_with(V.wide(F.col("_a")), V.wide(F.col("_b")), lambda x, y: F.abs(x - y))
    usable = F.coalesce(F.size("_a") == F.size("_b"), F.lit(False))
    rows = both.select(usable.alias("ok"), F.when(usable, F.array_max(pairs)).alias("top"), F.when(usable, V.total(pairs)).alias("sum"), F.when(usable, F.size(pairs)).alias("k"))
    out = rows.agg(
        F.count_if("ok").alias("n"), F.count_if(~F.col("ok")).alias("missing"), F.max("top").alias("max_abs"), (F.sum("sum") / F.sum("k")).alias("mean_abs")
    )
    return out.withColumn("within", (F.col("missing") == 0) & (F.coalesce("max_abs", F.lit(0.0)) <= tolerance))


def assert_same(got: DataFrame, expected: DataFrame, keys: list[str], value: str, tolerance: float) -> None:
    """Raise unless :func:`compare` is within the tolerance."""
    row = compare(got, expected, keys, value, tolerance).first()
    if not row.within:
        raise AssertionError(f"{value} differs: {row.asDict()}")


# How far results may differ from the reference's, by what is compared; texts and ids must be equal.
TOLERANCES = {"delta": 1e-4, "mixer": 1e-3, "layer": 1e-3, "attention": 1e-3, "rope": 8e-3, "model": 5e-1}


def verify(what: str, got: DataFrame, expected: DataFrame, keys: list[str], value: str) -> DataFrame:
    """:func:`compare` at the tolerance of what is compared; for a whole ``model`` the largest places must agree too."""
    out = compare(got, expected, keys, value, TOLERANCES[what])
    if what != "model":
        return out.withColumn("argmax", F.lit(None).cast("boolean"))
    both = got.select(*keys, V.argmax(F.col(value)).alias("_a")).join(expected.select(*keys, V.argmax(F.col(value)).alias("_b")), keys, "full_outer")
    same = both.agg(F.coalesce(F.every(F.col("_a").eqNullSafe(F.col("_b"))), F.lit(True)).alias("argmax"))
    return out.crossJoin(same).withColumn("within", F.col("within") & F.col("argmax"))


def verify_ids(got: DataFrame, expected: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys..., same, first, got, expected) of rows of ids: chat templates, generated, cached and batched tokens.

    ``first`` is the place from 0 of the first difference, and the ids there; null if there is none.
    """
    both = got.select(*keys, F.col(value).alias("_a")).join(expected.select(*keys, F.col(value).alias("_b")), keys, "full_outer")
    first = F.coalesce(first_mismatch(F.col("_a"), F.col("_b")), F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.lit(0).cast("bigint")))
    at = [F.try_element_at(F.col(c), (F.col("first") + 1).cast("int")).alias(n) for c, n in (("_a", "got"), ("_b", "expected"))]
    return both.withColumn("first", first).select(*keys, F.col("first").isNull().alias("same"), "first", *at)


def first_mismatch(a: Column, b: Column) -> Column:
    """Index from 0 of the first place where two arrays differ, their common length if one is longer; null if equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    at = F.nullif(F.array_position(same, 1), F.lit(0).cast("bigint")) - 1
    return F.coalesce(at, F.when(F.size(a) != F.size(b), n.cast("bigint")))


def matches(a: Column, b: Column) -> Column:
    """How many places of the common length agree."""
    n = F.least(F.size(a), F.size(b))
    return F.size(F.filter(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x.eqNullSafe(y)), lambda z: z))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", V.wide(F.col("embedding")).alias("v"), "label")


def _rounded(v: Column, digits: int = 6) -> Column:
    return F.transform(v, lambda x: F.round(x, digits))


VEC = "v as (select vec_id, list_transform(embedding, lambda x: x::double) as v, label from embeddings)"


@query(
    f"""with {VEC}, d as (select vec_id, v, list_transform(v, lambda x: x + case when vec_id % 50 = 0 then 0.005::double else 0 end) as w from v),
    m as (select max(list_max(list_transform(list_zip(v, w), lambda z: abs(z[1] - z[2])))) as top, count(*) as n,
      bool_and(list_position(v, list_max(v)) = list_position(w, list_max(w))) as same from d)
    select what, n, round(top, 9) as max_abs, top <= tol and (what <> 'model' or same) as within from m,
      (values ('delta', 1e-4), ('mixer', 1e-3), ('layer', 1e-3), ('attention', 1e-3), ('rope', 8e-3), ('model', 5e-1)) t(what, tol)"""
)
def verify_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of check over vectors of which some are off by 0.005."""
    given = _vectors(spark, sf_dir)
    off = given.select("vec_id", F.transform("v", lambda x: x + F.when(F.pmod("vec_id", F.lit(50)) == 0, 0.005).otherwise(0.0)).alias("v"))
    rows = [verify(what, off, given, ["vec_id"], "v").select(F.lit(what).alias("what"), "n", F.round("max_abs", 9).alias("max_abs"), "within") for what in TOLERANCES]
    return reduce(DataFrame.unionByName, rows)


@query(
    """with s as (select doc_id, string_split(text, ' ') as a, string_split(lower(text), ' ') as b from documents where text is not null),
    m as (select doc_id, a, b, list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i])[1] as k from s)
    select doc_id, k is null as same, k - 1 as first, a[k] as got, b[k] as expected from m"""
)
def verify_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text against its lower-case form: where they part, and with what."""
    rows = load(spark, sf_dir, "documents").where("text is not null")
    got, lower = (rows.select("doc_id", F.split(t, " ").alias("w")) for t in (F.col("text"), F.lower("text")))
    return verify_ids(got, lower, ["doc_id"], "w")


def _summary(v: Column) -> list[Column]:
    """Sum and weighted sum; they tell arrays apart without hashing numbers."""
    return [F.round(V.total(v), 5).alias("total"), F.round(V.total(F.transform(v, lambda x, i: x * (i + 1))), 4).alias("weighted")]


def _summary_sql(v: str) -> str:
    return f"round(list_sum({v}), 5) as total, round(list_sum(list_transform({v}, lambda x, i: x * i)), 4) as weighted"


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: x / sqrt(list_dot_product(v, v) + 1e-6))')} from v")
def l2norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.l2norm(F.col("v"))))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x, i: x / sqrt(list_dot_product(v, v) / len(v) + 1e-6) * (1 + (i - 1) * 0.01::double))')} from v")
def rmsnorm_1p(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.transform("v", lambda _, i: i * 0.01)
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.rmsnorm(F.col("v"), weight)))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: x / sqrt(list_dot_product(v, v) / len(v) + 1e-6) * x / (1 + exp(-x)))')} from v")
def gated_rmsnorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ones = F.transform("v", lambda _: F.lit(1.0))
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.gated_rmsnorm(F.col("v"), F.col("v"), ones)))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: exp(x - list_max(v)) / list_sum(list_transform(v, lambda y: exp(y - list_max(v)))))')} from v")
def softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.softmax(F.col("v"))))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: x - list_max(v) - ln(list_sum(list_transform(v, lambda y: exp(y - list_max(v))))))')} from v")
def log_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.log_softmax(F.col("v"))))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: x / (1 + exp(-x)))')} from v")
def silu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.silu(F.col("v"))))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: 1 / (1 + exp(-x)))')} from v")
def sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.sigmoid(F.col("v"))))


@query(f"with {VEC} select vec_id, {_summary_sql('list_transform(v, lambda x: greatest(x, 0) + ln(1 + exp(-abs(x))))')} from v")
def softplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.softplus(F.col("v"))))


@query(f"with {VEC} select vec_id, (list_position(v, list_max(v)) - 1)::bigint as best, list_sort(v, 'desc')[1] as top, list_sort(v, 'desc')[5] as fifth from v")
def argmax_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = V.top_k(F.col("v"), 5)
    return _vectors(spark, sf_dir).select("vec_id", V.argmax(F.col("v")).alias("best"), top[0]["value"].alias("top"), top[4]["value"].alias("fifth"))


@query(
    f"""with {VEC}, r as (select vec_id, v, vec_id % 50 as p, list_transform(range(8), lambda i: pow(10000::double, -2 * i / 16::double)) as f from v),
    t as (select vec_id, list_transform(v, lambda x, i: case when i > 16 then x when i > 8 then x * cos(p * f[i - 8]) + v[i - 8] * sin(p * f[i - 8])
      else x * cos(p * f[i]) - v[i + 8] * sin(p * f[i]) end) as o from r)
    select vec_id, {_summary_sql('o')} from t"""
)
def rope_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", *_summary(V.apply_rope(F.col("v"), F.pmod("vec_id", F.lit(50)), 16)))


@query(f"with {VEC}, q as (select v as w from v order by vec_id limit 1) select vec_id, round(list_dot_product(v, w), 5) as score from v, q order by list_dot_product(v, w) desc, vec_id limit 10")
def dot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors with the largest product with the first one, a report."""
    rows = _vectors(spark, sf_dir)
    first = rows.orderBy("vec_id").first()
    if first is None:
        return rows.select("vec_id", F.lit(0.0).alias("score"))
    score = V.dot(F.col("v"), F.array(*map(F.lit, first.v)))
    return rows.withColumn("s", score).orderBy(F.desc("s"), "vec_id").limit(10).select("vec_id", F.round("s", 5).alias("score"))


@query(f"with {VEC} select vec_id, " + ", ".join(f"round(list_sum(list_transform(v, lambda x, i: x * sin({r} * i))), 6) as out_{r}" for r in range(1, 5)) + " from v")
def linear_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector through a fixed 4-row matrix."""
    rows = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda r: F.transform("v", lambda _, i: F.sin(r * (i + 1))))
    return _vectors(spark, sf_dir).select("vec_id", _rounded(V.linear(F.col("v"), rows)).alias("out")).select("vec_id", *(F.col("out")[r - 1].alias(f"out_{r}") for r in range(1, 5)))


@query(
    f"""with {VEC}, b as (select vec_id, v, list_transform(v, lambda x: x::float * 1.5::float) as w from v),
    d as (select list_transform(v, lambda x, i: abs(x - w[i]::double)) as d from b)
    select count(*) as n, 0::bigint as missing, round(max(list_max(d)), 6) as max_abs, round(sum(list_sum(d)) / sum(len(d)), 6) as mean_abs from d"""
)
def compare_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    other = rows.select("vec_id", F.transform("v", lambda x: (x.cast("float") * F.lit(1.5).cast("float")).cast("float")).alias("v"))
    out = compare(rows, other, ["vec_id"], "v", 1e-3)
    return out.select("n", "missing", F.round("max_abs", 6).alias("max_abs"), F.round("mean_abs", 6).alias("mean_abs"))


@query(
    f"""with {VEC}, w as (select vec_id, list_position(v, list_max(v)) as a, list_position(list_transform(v, lambda x: -x), list_max(list_transform(v, lambda x: -x))) as b,
      list_position(list_transform(v, lambda x: x * 2), list_max(list_transform(v, lambda x: x * 2))) as c from v)
    select count(*) filter (where a = b) as negated, count(*) filter (where a = c) as doubled, count(*) as n from w"""
)
def argmax_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = V.argmax(F.col("v"))
    neg, twice = V.argmax(F.transform("v", lambda x: -x)), V.argmax(F.transform("v", lambda x: x * 2))
    return _vectors(spark, sf_dir).agg(F.count_if(best == neg).alias("negated"), F.count_if(best == twice).alias("doubled"), F.count("*").alias("n"))


@query(
    """with s as (select doc_id, string_split(text, ' ') as a, string_split(lower(text), ' ') as b from documents where text is not null),
    m as (select doc_id, len(a) as n, list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i]) as d from s)
    select doc_id, (n - len(d))::integer as hits, d[1] - 1 as first from m"""
)
def token_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text against its lower-case form: agreeing places and the first that differs."""
    a, b = F.split("text", " "), F.split(F.lower("text"), " ")
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", matches(a, b).alias("hits"), first_mismatch(a, b).alias("first"))


@query("select (event_id - (select min(event_id) from events)) // 100 as bucket, round(avg(value), 6) as loss, count(*) as n from events group by 1")
def running_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per hundred steps."""
    rows = load(spark, sf_dir, "events")
    first = rows.agg(F.min("event_id").alias("f")).first().f or 0
    return rows.groupBy(F.floor((F.col("event_id") - first) / 100).alias("bucket")).agg(F.round(F.avg("value"), 6).alias("loss"), F.count("*").alias("n"))


@query("select label, round(sqrt(sum(s)), 5) as norm, count(*) as n from (select label, list_sum(list_transform(embedding, lambda x: x::double * x::double)) as s from embeddings) group by 1")
def gradient_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).groupBy("label").agg(F.round(F.sqrt(F.sum(V.dot(F.col("v"), F.col("v")))), 5).alias("norm"), F.count("*").alias("n"))


@query(
    """with t as (select event_type, sum(abs(value)) as work, count(*) as n, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 as seconds from events group by 1)
    select event_type, n, round(n / seconds, 6) as per_second, round(work / seconds, 6) as work_per_second, round(n * 1.0 / max(n) over (), 6) as ratio from t"""
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    rows = load(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    t = rows.groupBy("event_type").agg(F.sum(F.abs("value")).alias("work"), F.count("*").alias("n"), ((F.max("us") - F.min("us")) / 1e6).alias("seconds"))
    top = F.max("n").over(W.partitionBy())
    return t.select("event_type", "n", F.round(F.col("n") / F.col("seconds"), 6).alias("per_second"), F.round(F.col("work") / F.col("seconds"), 6).alias("work_per_second"), F.round(F.col("n") / top, 6).alias("ratio"))


@query("select source as name, row_number() over (order by source) as place from (select distinct source from documents where source is not null)")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted set of repository names, one row each, numbered in parallel."""
    from hunkmill.operators.findings import number_rows

    names = load(spark, sf_dir, "documents").where("source is not null").select(F.col("source").alias("name")).distinct()
    return number_rows(names, "name", "place")


@query(
    """select vec_id, array_to_string(list_transform(range(0, 6), lambda j: case when j <= vec_id % 6 and (j >= vec_id % 3 or j = vec_id % 6) then 1 else 0 end), '') as open from embeddings"""
)
def pad_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of a padded causal mask per vector: which columns are open."""
    mask = V.pad_mask(F.lit(6), F.pmod("vec_id", F.lit(3)))
    row = F.element_at(mask, (F.pmod("vec_id", F.lit(6)) + 1).cast("int"))
    return load(spark, sf_dir, "embeddings").select("vec_id", F.array_join(F.transform(row, lambda x: F.when(x == 0, "1").otherwise("0")), "").alias("open"))


@query()
def delta_rule_1head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated delta rule over the vectors of each label in order; recursion, so no SQL: tested against numpy."""
    v = F.col("v")
    step = F.struct(
        "vec_id", V.l2norm(F.slice(v, 1, 4)).alias("q"), V.l2norm(F.slice(v, 5, 4)).alias("k"), F.slice(v, 9, 4).alias("v"),
        (-F.abs(v[12])).alias("g"), (1.0 / (1.0 + F.exp(-v[13]))).alias("beta"),
    )
    rows = _vectors(spark, sf_dir).groupBy("label", F.floor(F.col("vec_id") / 16).alias("chunk")).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return rows.select("label", "chunk", _rounded(F.element_at(V.delta_rule(F.col("steps"), 4, 4), -1)).alias("out"))
