import pytest
from pyspark.sql import functions as F

from hunkmill.operators import findings

RAW = "@@ -10,2 +10,3 @@ f\n a\n+b\n c"


def test_grounding(spark):
    df = spark.createDataFrame([(11,), (9999,), (None,), (10,), (12,), (13,)], "c bigint")
    got = [r.g for r in df.select(findings.grounded(F.col("c"), F.lit(RAW)).alias("g")).collect()]
    assert got == [True, False, True, True, True, False]
    row = spark.range(1).select(findings.first_added(F.lit(RAW)).alias("a"), findings.first_added(F.lit("@@ -1 +7 @@\n x")).alias("b")).first()
    assert (row.a, row.b) == (11, 7)


def test_identifier_ignores_session_but_not_pull_request(spark):
    def one(pr):
        cols = [F.lit(x) for x in ("m", "o/n")] + [F.lit(pr)] + [F.lit(x) for x in ("p", "@@", "body")]
        return spark.range(1).select(findings.finding_id(*cols).alias("x")).first().x

    assert one(1) == one(1) != one(2) and len(one(1)) == 16


LABEL = "struct<verdict: string, is_design_problem: boolean, severity: string, note: string, judged_at: string, judged_by: string>"
MACHINE = "struct<verdict: string, reason: string, judged_at: string, judged_by: string>"
SCHEMA = f"finding_id string, body string, human {LABEL}, machine {MACHINE}, ord int"


def test_merge(spark):
    human, machine = ("accept", True, None, None, "t", "h"), ("reject", None, "t", "j")
    store = spark.createDataFrame([("a", "old", human, machine, 1), ("b", "old", None, machine, 2)], SCHEMA)
    fresh = spark.createDataFrame([("a", "new1", None, None, 1), ("a", "new2", None, None, 2), ("c", "new", None, None, 3)], SCHEMA)

    def rows(df):
        return {r.finding_id: (r.body, r.human and r.human.verdict, r.machine and r.machine.verdict) for r in df.collect()}

    once = findings.merge_findings(store, fresh, "ord")
    assert rows(once) == {"a": ("new2", "accept", None), "b": ("old", None, "reject"), "c": ("new", None, None)}
    assert rows(findings.merge_findings(store, fresh, "ord", keep_machine=True))["a"][2] == "reject"
    again = findings.merge_findings(once.withColumn("ord", F.lit(1)).drop("place"), fresh, "ord")
    assert rows(again) == rows(once)
    assert [r.finding_id for r in once.orderBy("place").collect()] == ["a", "b", "c"]
    assert rows(findings.merge_findings(store.limit(0), fresh, "ord")).keys() == {"a", "c"}


def test_decisions_stop_at_q(spark):
    store = spark.createDataFrame([(x, "", None, None, 1) for x in "abcde"], SCHEMA)
    turns = [("a", 1, " Accept", " good ", "t"), ("b", 2, "r", None, "t"), ("c", 3, "", "", "t"), ("d", 4, "q", "", "t"), ("e", 5, "a", "", "t")]
    decisions = spark.createDataFrame(turns, "finding_id string, turn int, choice string, note string, judged_at string")
    got = {r.finding_id: r.human for r in findings.apply_decisions(store, decisions, "me").collect()}
    assert got["a"].verdict == "accept" and got["a"].is_design_problem and got["a"].note == "good" and got["a"].severity is None
    assert got["b"].verdict == "reject" and got["b"].note is None
    assert got["c"] is got["d"] is got["e"] is None


def test_verdict_names_are_checked_first(spark):
    with pytest.raises(ValueError):
        findings.with_verdict(spark.createDataFrame([], SCHEMA), "maybe")


def test_numbers_are_those_of_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    rows = findings.number_rows(df.repartition(5), "k", "n").orderBy("k").collect()
    assert [r.n for r in rows] == list(range(1, 1001))


def test_wide_rows_are_all_numbered_once(spark):
    """The wide columns are read too, so that the counts' side of the plan is much narrower than the rows'; adaptive execution is on."""
    n, before = 300_000, spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wide = [F.sha2(F.concat_ws("-", "id", F.lit(k)), 512).alias(f"c{k}") for k in range(4)]
        df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), *wide)
        numbered = findings.number_rows(df.repartition(7), "k", "n").withColumn("long", F.length(F.concat(*[f"c{k}" for k in range(4)])))
        got = numbered.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.count_if(F.col("n") != F.col("k") + 1), F.sum("long"))
        assert tuple(got.first()) == (n, n, 1, n, 0, n * 4 * 128)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
