import random

from pyspark.sql import functions as F

from hunkmill.operators import scalars
from hunkmill.operators.components import components


def roots(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components_against_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 260)] + [(300, k) for k in range(301, 340)]
    pairs = [(a, b) for a, b in pairs if a != b]
    df = spark.createDataFrame([("x", a, b) for a, b in pairs] + [("y", 1, 2), ("y", 5, 5), ("y", None, 2)], "g string, u int, v int")
    got = {(r.g, r.node): r.root for r in components(df, "g").collect()}
    assert got == {("x", k): v for k, v in roots(pairs).items()} | {("y", 1): 1, ("y", 2): 1}
    assert components(df.limit(0), "g").count() == 0


def test_later_changes_against_brute_force(spark):
    rng = random.Random(4)
    changes = [(rng.choice("rs"), rng.choice("pq"), first := rng.randrange(60), first + rng.choice([-1, 0, 1, 7, 30, 5000]), rng.randrange(50)) for _ in range(150)]
    flags = [(k, rng.choice("rs"), rng.choice("pq"), rng.choice([None, *range(70), 3000]), rng.randrange(50)) for k in range(300)]
    for reach in (0, 3):
        got = scalars.touched_later(
            spark.createDataFrame(flags, "flag int, repo string, path string, line int, at int"),
            spark.createDataFrame(changes, "repo string, path string, first int, last int, at int").withColumn("first", F.col("first").cast("bigint")).withColumn("last", F.col("last").cast("bigint")), reach,
        )
        expected = {
            k for k, r, p, line, at in flags if line is not None and any(c[:2] == (r, p) and c[2] <= c[3] and c[2] - reach <= line <= c[3] + reach and c[4] > at for c in changes)
        }
        assert {r.flag for r in got.collect()} == expected


def test_related_concerns_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [("o/n", 1, f"p{k % 7}", f"f{k:03d}", " ".join(["the", "lock"] + rng.choices("abcdefghij", k=rng.randint(1, 5)))) for k in range(80)]
    df = spark.createDataFrame(rows, "repo string, pr int, path string, finding_id string, critic_comment string")
    for least in (0.3, 0.5, 1.0):
        got = {(r.a, r.b) for r in scalars.related_concerns(df, least).collect()}
        sets = [(p, f, set(t.split())) for _, _, p, f, t in rows]
        assert got == {(f, g) for p, f, x in sets for q, g, y in sets if f < g and p != q and len(x & y) / len(x | y) >= least}
