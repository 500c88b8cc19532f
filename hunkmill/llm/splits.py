"""Splits that keep related records together.

Comments are bound by their pull request and by their file.  The classes are the connected
components of that relation, found by Borůvka contraction: every component picks its lightest
outgoing edge, the picked edges join the persisted spanning forest, the trees they form are
contracted, and the graph is rebuilt between the trees.  Roots are then stratified by size band
and dealt systematically to the splits.

Every table an iteration needs again is written to the shared folder, so a lost executor costs
one stage at most.  Nothing but row counts reaches the driver.

Defined results:

* The classes' label is the smallest identifier in them; a record that nothing binds is alone.
* Null identifiers get no row, but what such a record binds stays bound.
* Null or blank pull requests and paths bind nothing; a path without a repository binds nothing.
* Repeated rows and several deliveries of one identifier count as one record that is bound by
  what any of them says.
* An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill import workspace
from hunkmill.llm import spellings


def bindings(comments: DataFrame) -> DataFrame:
    """(id, key): the pull request and the file that bind each comment, one row per pair.

    Identifiers of null are replaced by negative numbers of their own, which never become labels.
    """
    pr = spellings.pull_request(F.col("pull_request_url"))
    repo = spellings.repository(F.col("pull_request_url"))
    slim = comments.select(
        F.col("id").alias("id"), pr.alias("pr"), F.concat(repo, F.lit(" "), spellings.file_path(F.col("path"))).alias("file")
    ).distinct()
    ids = F.coalesce("id", -F.abs(F.xxhash64("pr", "file")) - 1)
    keys = F.array_compact(F.array(F.concat(F.lit("p "), F.col("pr")), F.concat(F.lit("f "), F.col("file"))))
    return slim.select(ids.alias("id"), F.explode_outer(keys).alias("key"))


def contract(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Borůvka contraction of undirected ``edges`` (u, v).

    Returns (node, root) of every node, and the spanning forest as (u, v) edges of the input.
    The weight of an edge is a hash of its ends, so all weights differ and the picked trees stay
    shallow.  Each round at least halves the nodes that still have an edge.
    """
    spark = edges.sparkSession
    lo, hi = F.least("u", "v"), F.greatest("u", "v")
    start = edges.where("u <> v").select(lo.alias("u"), hi.alias("v")).distinct()
    live = workspace.keep(start.select("u", "v", F.col("u").alias("from_u"), F.col("v").alias("from_v")), "edges")
    maps: list[DataFrame] = []
    forest: list[DataFrame] = []
    while not live.isEmpty():
        edge = F.struct(F.xxhash64("from_u", "from_v").alias("w"), "u", "v", "from_u", "from_v")
        ends = live.select(F.explode(F.array("u", "v")).alias("node"), edge.alias("edge"))
        pick = workspace.keep(ends.groupBy("node").agg(F.min("edge").alias("edge")), "picks")
        forest.append(workspace.keep(pick.select(F.col("edge.from_u").alias("u"), F.col("edge.from_v").alias("v")).distinct(), "forest"))
        # the lighter end of a mutual pick is the root of its tree
        other = F.when(F.col("node") == F.col("edge.u"), F.col("edge.v")).otherwise(F.col("edge.u"))
        mutual = pick.groupBy("edge.from_u", "edge.from_v").agg(F.count("*").alias("n"), F.min("node").alias("root"))
        roots = mutual.where("n = 2").select(F.col("root").alias("node"), F.lit(True).alias("is_root"))
        up = workspace.keep(
            pick.join(roots, "node", "left").select("node", F.when(F.col("is_root"), F.col("node")).otherwise(other).alias("root")),
            "up",
        )
        while True:  # halve the distance to the root
            above = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jump = up.join(above, "root").select(
                "node", F.col("above").alias("root"), (F.col("root") != F.col("above")).alias("moved")
            )
            flat = workspace.keep(jump, "up")
            workspace.forget(up)
            up = flat.select("node", "root")
            if flat.where("moved").isEmpty():
                break
        maps.append(up)
        a = up.select(F.col("node").alias("u"), F.col("root").alias("root_u"))
        b = up.select(F.col("node").alias("v"), F.col("root").alias("root_v"))
        moved = live.join(a, "u").join(b, "v").where("root_u <> root_v")
        ru, rv = F.least("root_u", "root_v"), F.greatest("root_u", "root_v")
        best = F.min(F.struct(F.xxhash64("from_u", "from_v").alias("w"), "from_u", "from_v")).alias("b")
        fresh = workspace.keep(
            moved.groupBy(ru.alias("u"), rv.alias("v")).agg(best).select("u", "v", "b.from_u", "b.from_v"), "edges"
        )
        workspace.forget(live)
        workspace.forget(pick)
        live = fresh
    none = spark.createDataFrame([], "node bigint, root bigint")
    if not maps:
        return none, spark.createDataFrame([], "u bigint, v bigint")
    nodes = maps[0]
    for level in maps[1:]:  # a root of one round is a node of a later one, or stays
        step = level.select(F.col("node").alias("root"), F.col("root").alias("top"))
        nodes = nodes.join(step, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    grown = forest[0]
    for more in forest[1:]:
        grown = grown.unionByName(more)
    return nodes, grown


def related_groups(comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, group_id) of every distinct identifier, and the spanning forest as (u, v) of identifiers.

    Each key is first replaced by the smallest identifier it binds, its hub, by an aggregation that combines
    on the map side; so a pull request with a third of all comments is one node, not a hot group.

    The ends of each edge of the forest share a key, and a group of n records has n - 1 edges: a comment that
    is no hub hangs on its first one, and an edge between hubs that such a comment ties is led through it.
    Records of null identifiers stand in the forest under their negative numbers.
    """
    bound = workspace.keep(bindings(comments), "bindings")
    hub = bound.where("key is not null").groupBy("key").agg(F.min("id").alias("hub"))
    linked = workspace.keep(bound.join(hub, "key", "left").select("id", F.coalesce("hub", "id").alias("hub")).distinct(), "links")
    workspace.forget(bound)
    first = linked.groupBy("id").agg(F.min("hub").alias("first"), F.max("hub").alias("last"), F.count("*").alias("n"))
    node = F.col("last") == F.col("id")  # hubs aren't larger than what they bind
    via = F.when(~node, F.col("id")).alias("via")
    ends = linked.join(first.where("n > 2"), "id").select(F.when(node, F.col("id")).otherwise(F.col("first")).alias("u"), F.col("hub").alias("v"), via)
    edges = first.where("n > 1").select(F.col("first").alias("u"), F.col("last").alias("v"), via).unionByName(ends)
    nodes, between = contract(edges)
    ties = edges.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.min(F.struct(F.col("via").isNotNull(), "via")).alias("t"))
    start = F.coalesce("t.via", "u")
    led = between.join(ties, ["u", "v"]).select(F.least(start, "v").alias("u"), F.greatest(start, "v").alias("v"))
    forest = led.unionByName(first.where(~node).select(F.col("first").alias("u"), F.col("id").alias("v")))
    rooted = first.select("id", "first").join(nodes, F.col("first") == F.col("node"), "left")
    member = rooted.select("id", F.coalesce("root", "first").alias("root")).where("id >= 0 or root is not null")
    label = member.where("id >= 0").groupBy("root").agg(F.min("id").alias("group_id"))
    return member.where("id >= 0").join(label, "root").select("id", "group_id"), forest


def persist_forest(forest: DataFrame, path: str) -> DataFrame:
    """The spanning forest as a table that outlives the application, at a path of the caller's."""
    forest.write.mode("overwrite").parquet(path)
    return forest.sparkSession.read.schema(forest.schema).parquet(path)


#: Groups that one window takes in, about: slices of a size band are as many as that asks for.
SLICE_GROUPS = 4096
GOLDEN = 0.6180339887498949


def deal(groups: DataFrame, shares: dict[str, int], seed: int = 7) -> DataFrame:
    """(id, group_id, split): whole groups dealt to splits in the given per-mille ``shares``.

    Groups are laid end to end on a line, the largest size band first, inside a band in hashed order.  The middle
    of a group, in golden-ratio steps of its band's size, falls into a part of the unit, which is parted by the
    shares, and so says its split; every band meets the shares by itself, one of few large groups as nearly as they allow.
    The order is made of band and the hash's first digits, whose totals are added up along one window, a row for
    about ``SLICE_GROUPS`` groups; within such a slice a window runs over its groups only.
    """
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("size"))
    placed = sizes.select(
        "group_id",
        "size",
        F.floor(F.log2("size")).cast("int").alias("band"),
        F.md5(F.concat_ws("-", F.col("group_id").cast("string"), F.lit(seed))).alias("h"),
    )
    placed = workspace.keep(placed, "placed")
    count, digits = placed.count(), 1
    while count > SLICE_GROUPS * 16**digits:
        digits += 1
    placed = placed.withColumn("slice", F.left("h", F.lit(digits)))
    totals = placed.groupBy("band", "slice").agg(F.sum("size").alias("total"))
    before = F.sum("total").over(W.orderBy(F.desc("band"), "slice").rowsBetween(W.unboundedPreceding, -1))
    offsets = totals.select("band", "slice", F.coalesce(before, F.lit(0)).alias("offset"))
    inner = F.sum("size").over(W.partitionBy("band", "slice").orderBy("h", "group_id").rowsBetween(W.unboundedPreceding, 0))
    line = placed.withColumn("end", inner).join(offsets, ["band", "slice"])
    middle = F.col("offset") + F.col("end") - F.col("size") / 2.0
    # systematic: the golden ratio's multiples fill the unit evenly, and no size of groups keeps step with them
    spot = F.pmod(middle / F.pow(F.lit(2.0), F.col("band")) * GOLDEN, F.lit(1.0)) * 1000
    whole, split, upto = sum(shares.values()), None, 0
    for name, share in shares.items():
        upto += share * 1000 / whole
        split = F.when(spot < upto, name) if split is None else split.when(spot < upto, name)
    dealt = line.select("group_id", split.otherwise(list(shares)[-1]).alias("split"))
    return groups.join(dealt, "group_id").select("id", "group_id", "split")


def shares_of(settings: DataFrame) -> dict[str, int]:
    """Per-mille shares of the splits from the settings table, which has a fixed few rows."""
    rows = {r.setting: r.per_mille for r in settings.collect()}
    return {s: int(rows.get(f"{s}_share") or 0) for s in ("train", "validation", "test")}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id) of every distinct comment."""
    return related_groups(workspace.load(spark, sf_dir, "review_comments"))[0]


def p1_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(u, v): the spanning forest that proves the groups."""
    return related_groups(workspace.load(spark, sf_dir, "review_comments"))[1]


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id, split) of every distinct comment."""
    groups = workspace.keep(related_groups(workspace.load(spark, sf_dir, "review_comments"))[0], "groups")
    return deal(groups, shares_of(workspace.load(spark, sf_dir, "curation_settings")))


P1_SQL = r"""with recursive
clean as (select id, regexp_replace(regexp_replace(lower(pull_request_url), '[\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}]', '', 'g'), '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') as u,
    regexp_replace(regexp_replace(path, '[\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}]', '', 'g'), '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') as p from review_comments where id is not null),
parts as (select id, regexp_extract(u, '(?:^|/)([^/\s?#]+/[^/\s?#]+)/(?:pulls?|issues?)/0*([0-9]+)(?:[/?#].*)?$', 1) as repo,
    regexp_extract(u, '(?:^|/)([^/\s?#]+/[^/\s?#]+)/(?:pulls?|issues?)/0*([0-9]+)(?:[/?#].*)?$', 2) as num,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p, '\\', '/', 'g'), '/+', '/', 'g'), '/(?:\./)+', '/', 'g'), '^(?:\.?/)+', ''), '^[ab]/', '') as f from clean),
keys as (select distinct id, unnest([repo || '#' || num, case when f <> '' then repo || ' ' || f end]) as key from parts),
hubs as (select key, min(id) as hub from keys where key is not null group by 1),
edges as (select distinct id as a, hub as b from keys join hubs using (key) where id <> hub),
both_ways as (select a, b from edges union select b, a from edges),
cc(id, g) using key (id) as (
  select distinct id, id as g from clean
  union
  select e.b, min(n.g) from cc n join both_ways e on e.a = n.id join recurring.cc o on o.id = e.b where n.g < o.g group by e.b)
select id, g as group_id from cc
"""
GROUPS_SQL = P1_SQL.rstrip().removesuffix("select id, g as group_id from cc").rstrip()
P1_SPLITS_SQL = GROUPS_SQL + """,
sizes as (select g, count(*) as size from cc group by 1),
placed as (select *, floor(log2(size))::integer as band, md5(g || '-7') as h from sizes),
line as (select *, (sum(size) over (order by band desc, h, g))::double - size / 2.0::double as middle from placed),
spots as (select g, (middle / pow(2.0, band) * 0.6180339887498949::double) % 1.0::double * 1000 as spot from line),
shares as (select max(per_mille) filter (where setting = 'train_share') as a, max(per_mille) filter (where setting = 'validation_share') as b, max(per_mille) filter (where setting = 'test_share') as c from curation_settings)
select id, g as group_id, case when spot < a * 1000 / (a + b + c) then 'train' when spot < (a + b) * 1000 / (a + b + c) then 'validation' else 'test' end as split
from cc join spots using (g), shares
"""
