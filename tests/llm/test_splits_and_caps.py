import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hunkmill.llm import caps, spellings, splits


def test_spellings(spark):
    urls = [
        "https://api.forge.example/repos/Own/name/pulls/12", " http://api.forge.example/repos/own/NAME/pulls/012\n", "https://forge.example/own/name/pull/12#discussion_r1",
        "https://forge.example/own/name/pull/12/files", "https://API.forge.example/repos/own/name/pulls/12/comments", "https://api.forge.example/repos/own/name/pulls/12?per_page=100",
        "https://api.forge.example/repos/own/name/pulls/12/",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.k for r in df.select(spellings.pull_request(F.col("u")).alias("k")).collect()} == {"own/name#12"}
    odd = spark.createDataFrame([("",), (None,), ("Elsewhere",)], "u string").select(spellings.pull_request(F.col("u")).alias("k"), spellings.repository(F.col("u")).alias("r")).collect()
    assert [(r.k, r.r) for r in odd] == [(None, None), (None, None), ("elsewhere", None)]
    paths = ["src/x/y.rs", "./src/x/y.rs", "/src/x/y.rs", "b/src/x/y.rs", "a/src/x/y.rs", "src\\x\\y.rs", "src/./x/y.rs", "src//x/y.rs\t", " src/x/y.rs "]
    df = spark.createDataFrame([(u,) for u in paths], "u string")
    assert {r.k for r in df.select(spellings.file_path(F.col("u")).alias("k")).collect()} == {"src/x/y.rs"}
    names = ["Tuna-Ish", "@tuna-ish ", " TUNA-ISH", "tuna-ish​", " @Tuna-Ish"]
    df = spark.createDataFrame([(u,) for u in names], "u string")
    assert {r.k for r in df.select(spellings.login(F.col("u")).alias("k")).collect()} == {"tuna-ish"}
    assert spark.range(1).select(spellings.login(F.lit("Tuna-Ish[bot]")).alias("k")).first().k == "tuna-ish[bot]"


SCHEMA = "id bigint, pull_request_url string, path string, hub bigint, key string"


def components(rows):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (i, url, path, *_) in enumerate(rows):
        node = ("id", i) if i is not None else ("null", url, path)
        find(node)
        m = re.search(r"([^/]+/[^/]+)/pulls?/(\d+)", (url or "").strip().lower())
        for key in ([("pr", m[0])] if m else []) + ([("file", m[1], path)] if m and path else []):
            parent[find(node)] = find(key)
    groups = defaultdict(list)
    for i in {r[0] for r in rows if r[0] is not None}:
        groups[find(("id", i))].append(i)
    return {i: min(g) for g in groups.values() for i in g}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_groups_against_union_find(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(rng.choice([60, 250])):
        url = None if rng.random() < 0.1 else f"https://api.forge.example/repos/o{rng.randint(0, 4)}/n/pulls/{rng.randint(1, 40)}"
        path = rng.choice([None, "", *[f"f{k}" for k in range(60)]])
        rows.append((None if rng.random() < 0.03 else rng.randint(0, 150), url, path, 7, "clash"))
    rows += rows[:20]
    groups, forest = splits.related_groups(spark.createDataFrame(rows, SCHEMA))
    assert {r.id: r.group_id for r in groups.collect()} == components(rows)
    edges = [(r.u, r.v) for r in forest.collect()]
    assert len(edges) == len({tuple(sorted(e)) for e in edges})


def test_forest_spans_without_cycles(spark):
    edges = [(k, k + 1) for k in range(200)] + [(k, k + 7) for k in range(190)] + [(1000, 1001)]
    nodes, forest = splits.contract(spark.createDataFrame(edges, "u bigint, v bigint"))
    roots = {r.node: r.root for r in nodes.collect()}
    assert len(roots) == 203 and len(set(roots.values())) == 2
    assert forest.count() == 201


def test_empty_tables(spark):
    groups, forest = splits.related_groups(spark.createDataFrame([], SCHEMA))
    assert groups.count() == forest.count() == 0
    assert splits.deal(groups, {"train": 800, "validation": 100, "test": 100}).count() == 0


def test_dealing_meets_the_shares_and_keeps_groups(spark):
    groups = spark.range(20_000).selectExpr("id", "case when id < 6000 then 0 else id - id % (1 + id % 5) end as group_id")
    rows = splits.deal(groups, {"train": 800, "validation": 100, "test": 100})
    assert rows.groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    counts = {r.split: r.n for r in rows.where("group_id <> 0").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["train"] / 14_000 - 0.8) < 0.004 and abs(counts["test"] / 14_000 - 0.1) < 0.004
    assert rows.count() == 20_000
    # with the large group: it is in one split, and every band of sizes has the shares as nearly as its groups allow
    large = rows.where("group_id = 0").select("split").distinct().collect()
    assert len(large) == 1
    sizes = rows.groupBy("group_id", "split").agg(F.count("*").alias("n"))
    for band in sizes.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum(F.when(F.col("split") == "train", F.col("n"))).alias("t")).collect():
        assert abs((band.t or 0) - 0.8 * band.n) <= 10 * band.most + 0.002 * band.n


def test_slices_change_nothing(spark, monkeypatch):
    groups = spark.range(3000).selectExpr("id", "id - id % (1 + id % 3) as group_id")
    one = {r.id: r.split for r in splits.deal(groups, {"train": 700, "validation": 200, "test": 100}).collect()}
    monkeypatch.setattr(splits, "SLICE_GROUPS", 10)
    assert {r.id: r.split for r in splits.deal(groups, {"train": 700, "validation": 200, "test": 100}).collect()} == one


def test_forest_is_kept_where_the_caller_says(spark, tmp_path):
    _, forest = splits.contract(spark.createDataFrame([(1, 2), (2, 3)], "u bigint, v bigint"))
    path = str(tmp_path / "forest")
    assert splits.persist_forest(forest, path).count() == 2 and spark.read.parquet(path).count() == 2


def test_cutoffs_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(caps, "BROADCAST_CUTOFFS", 1)
    rng = random.Random(9)
    rows = [(k, f"w{rng.randint(0, 40)}", rng.choice([0.1, 0.5, None]), "x", 1) for k in range(400)]
    got = caps.beyond_cap(spark.createDataFrame(rows, CAP), 3, "who", "score", "ident")
    assert sorted((r.ident for r in got.collect()), key=str) == allowed(rows, 3)


CAP = "ident bigint, who string, score float, code string, n int"


def allowed(rows, limit):
    gone = []
    for who in {r[1] for r in rows if r[1] is not None}:
        own = [r for r in rows if r[1] == who]
        rank = lambda r: (-(r[2] if r[2] is not None and r[2] == r[2] else float("-inf")), r[0] if r[0] is not None else 2**63)
        gone += [r[0] for r in sorted(own, key=rank)[limit:]]
    return sorted(gone, key=str)


@pytest.mark.parametrize("limit", [1, 2, 5, 40, 1000])
def test_caps_against_sorting(spark, limit):
    rng = random.Random(limit)
    scores = [0.0, -0.0, 1.0, 0.5, None, float("nan"), -2.5, 1e-40, float("inf"), float("-inf"), 0.3]
    rows = [(k * 1000 - 50_000, rng.choice(["a", "a", "b", "c", None]), rng.choice(scores), "x", 1) for k in range(200)]
    rows += [(None, "a", 0.5, "x", 1)]
    rows += [rows[3], rows[3], rows[9]]
    got = caps.beyond_cap(spark.createDataFrame(rows, CAP), limit, "who", "score", "ident")
    assert sorted((r.ident for r in got.collect()), key=str) == allowed(rows, limit)


def test_caps_edge_cases(spark):
    assert caps.beyond_cap(spark.createDataFrame([], CAP), 1, "who", "score", "ident").count() == 0
    same = spark.createDataFrame([(5, "a", 0.5, "", 1)] * 7, CAP)
    assert caps.beyond_cap(same, 3, "who", "score", "ident").count() == 4
    assert [caps.share_limit(n, 25) for n in (0, 39, 40, 100)] == [1, 1, 1, 2]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_forest_proves_the_groups(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 120), f"https://api.forge.example/repos/o{rng.randint(0, 3)}/n/pulls/{rng.randint(1, 30)}", rng.choice([None, *[f"f{k}" for k in range(40)]]), 7, "x") for _ in range(150)]
    rows += [(k, "https://api.forge.example/repos/alone/n/pulls/1", None, 7, "x") for k in range(500, 540)]
    groups, forest = splits.related_groups(spark.createDataFrame(rows, SCHEMA))
    group = {r.id: r.group_id for r in groups.collect()}
    edges = [(r.u, r.v) for r in forest.collect()]
    assert len(edges) == len(group) - len(set(group.values()))
    keys = defaultdict(set)
    for i, url, path, *_ in rows:
        repo, number = re.search(r"repos/(.+)/pulls/(\d+)", url).groups()
        keys[i] |= {number + " of " + repo} | ({repo + " " + path} if path else set())
    assert all(keys[u] & keys[v] for u, v in edges)
    parent = {i: i for i in group}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        assert find(u) != find(v)
        parent[find(u)] = find(v)
    assert len({find(i) for i in group}) == len(set(group.values()))
