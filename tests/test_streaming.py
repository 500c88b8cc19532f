from hunkmill import queries as core

SF = "/root/testdata/sf0.001"


def test_live_limits_equal_the_fold(spark):
    q = core.queries()
    live = {(r.user_id, r.answers, r.limit) for r in q["live_limiter"](spark, SF).collect()}
    assert live == {(r.user_id, r.answers, r.limit) for r in q["limiter_fold"](spark, SF).collect()}


def test_length_batches(spark):
    from hunkmill.operators.examples import length_batches

    df = spark.range(100).selectExpr("id as k", "id % 13 as n")
    rows = length_batches(df, "k", "n", 4, 5).orderBy("mega", "slot").collect()
    assert sorted(r.k for r in rows) == list(range(100))
    for m in range(5):
        lengths = [r.n for r in rows if r.mega == m]
        assert len(lengths) == 20 and lengths == sorted(lengths, reverse=True)


def test_quantile_instant_is_exact(spark):
    import random

    from pyspark.sql import functions as F

    from hunkmill.operators.examples import quantile_instant

    rng = random.Random(1)
    values = [rng.choice([rng.randrange(10**15), 10**15 + rng.randrange(50), -rng.randrange(10**9)]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    for share in (0.01, 0.25, 0.5, 0.9, 1.0):
        expected = next(v for k, v in enumerate(sorted(values), 1) if sum(x <= v for x in values) >= share * len(values))
        assert quantile_instant(df, F.col("v"), share) == expected
    assert quantile_instant(df.limit(0), F.col("v"), 0.5) is None
