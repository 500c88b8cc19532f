"""Near-duplicate records with small edits, by min-max hashing.

A text is the bag of its words; the n-th copy of a word is an element of its own, so bags are sets.
Each permutation gives two signature values, the smallest and the largest hash of the bag, from
one evaluation per element.  A band is the minimum and maximum of the body under one permutation, those
of the hunk under one, and the minimum (even bands) or maximum (odd bands) of the hunk under another that
two bands share.  Two comments that share a band are candidates; candidates whose lengths or parity
bitmaps rule the threshold out are dropped, and each of the rest is measured exactly.  Both tests are
bounds that hold for every pair, so they lose nothing.

Comments with equal bags are one class, represented by its smallest identifier, before any pair is
formed, so exact copies cost nothing.  The bands are joined, not collected, and pairs are written
only where they are results.

The bands are joined some at a time (``SLICE``), with lengths and bitmaps in the rows, so chance meetings,
which grow with the square of the corpus, end inside the join and are never written; the shuffle files of
one slice go before the next.

A band that many classes share (many bodies on one hunk, or a stock body on like hunks) would pair all of
them.  Such hot bands are found by their share of a sample of classes.  If they are worth it, they leave the
join, and their members are searched by prefix filtering instead, which is exact: two bags that share four
fifths of the longer one's elements also share one of the first ``n // 5 + 1`` elements of either in any
common order, here rare ones first.  This holds for the body and for the hunk, so each member looks only on
the side whose first elements are rarer, among all members' first elements of that side.  Both ways' meetings
are counted (of many members, for a sample) before either is taken: where many members have few words between
them, prefixes meet more often.

With both texts at the threshold (four fifths of equally long bags, Jaccard 2/3) a band agrees with
probability (2/3)^5 = 0.132, so ``BANDS`` = 36 bands miss 0.6 % of such pairs; where one text shares
nine tenths, one in 10,000 is missed.  Recall is measured in the tests.

Defined results:

* Words are runs of letters or digits, in folded case, counted with repeats.
* A comment without words in either field, null or not, is in no pair.
* Of several deliveries the ledger's winner counts.  Null identifiers are in no pair.
* An empty table gives no rows; extra columns play no part; texts are read in full.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill import workspace
from hunkmill.operators.deliveries import instant_us, preference

BANDS = 36
#: Bits of the parity bitmaps of a body and of a hunk.
BITMAPS = (128, 256)
#: A band is hot if, of one class in ``HOT_SAMPLE``, at least ``HOT_SEEN`` have it: if about 256 classes share it.
#: Either way of search is complete, so the sample decides on cost only.
HOT_SAMPLE, HOT_SEEN = 64, 4
#: Of more members of hot bands than that, about so many are searched by prefixes first, to see what all would take.
HOT_TRIED = 4096
#: Bands that are joined at a time.
SLICE = 6
#: An element that makes up at least one in so many of all counted ones is broadcast with its count: so many rows at most.
COMMON = 1000
#: At least this many fifths of the longer text's words must be shared.
FIFTHS = 4
#: Identifiers that may be broadcast to fetch the candidates' texts: 16 bytes each, 32 MB at most.
BROADCAST_IDS = 2_000_000
WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = x * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1))
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xBF58476D1CE4E5B9)


def bags(texts: list[str | None], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(elements, lengths): the bags of all texts, one after another."""
    words = [WORD.findall(t.casefold()) if t else [] for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, int(lengths.sum()))
    # number the copies of a word inside its text: sort by text and hash, count along the runs
    owner = np.repeat(np.arange(len(words), dtype=np.uint64), lengths)
    order = np.argsort((owner << np.uint64(42)) | (flat >> np.uint64(22)), kind="stable")
    w, o = flat[order], owner[order]
    first = np.ones(len(w), bool)
    first[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(w))
    copy = at - np.maximum.accumulate(np.where(first, at, 0))
    elements = w ^ (copy.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return elements, lengths


def _permutations(n: int) -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(20240229)
    flips, factors = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
    return list(zip(flips, factors | np.uint64(1), strict=True))


def _minmax(elements: np.ndarray, lengths: np.ndarray, permutations: list) -> tuple[np.ndarray, np.ndarray]:
    """(texts x permutations) smallest and largest hashes."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    low, high = (np.empty((len(lengths), len(permutations)), np.uint64) for _ in range(2))
    for p, (flip, factor) in enumerate(permutations):
        h = (elements ^ flip) * factor
        low[:, p], high[:, p] = np.minimum.reduceat(h, starts), np.maximum.reduceat(h, starts)
    return low, high


def _parity(elements: np.ndarray, lengths: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bitmaps of ``bits`` bits as 64-bit words: each element flips one bit.

    Two bags that differ in d elements differ in at most d bits, so n + m - (bits that differ) is at least
    twice the number of elements that bags of n and m elements share.
    """
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = _mix(elements, 11) >> np.uint64(32)
    flip = np.uint64(1) << (place & np.uint64(63))
    word = (place >> np.uint64(6)) % np.uint64(bits // 64)
    return [np.bitwise_xor.reduceat(np.where(word == w, flip, np.uint64(0)), starts) for w in range(bits // 64)]


PARITY = [[f"{field}_{w}" for w in range(bits // 64)] for field, bits in zip(("body", "hunk"), BITMAPS, strict=True)]
SIGNED = (
    "id bigint, delivery_id bigint, cls_a bigint, cls_b bigint, body_n int, hunk_n int, "
    + ", ".join(f"{c} bigint" for side in PARITY for c in side)
    + ", bands array<bigint>"
)


def _signed(batches: Iterator[pa.RecordBatch], bands: int) -> Iterator[pa.RecordBatch]:
    hashes, permutations = _Hashes(), _permutations(2 * bands)
    shared = np.arange(bands) // 2  # two bands share a permutation of the hunk
    even = np.arange(bands) % 2 == 0
    for batch in batches:
        parts = [bags(batch.column(c).to_pylist(), hashes) for c in ("body", "diff_hunk")]
        full = (parts[0][1] > 0) & (parts[1][1] > 0)
        n = int(full.sum())
        if not n:
            continue
        # the band's number is part of its key
        keys = np.repeat(_mix(np.arange(1, bands + 1, dtype=np.uint64), 40)[None, :], n, axis=0)
        cls = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
        counts, bits = [], []
        for side, (elements, lengths) in enumerate(parts):
            elements, lengths = elements[np.repeat(full, lengths)], lengths[full]
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            for k in (0, 1):
                cls[k] = _mix(cls[k] + np.add.reduceat(_mix(elements, k + 5), starts), side + 2)
            low, high = _minmax(elements, lengths, permutations[: bands + side * ((bands + 1) // 2)])
            keys = _mix(_mix(keys + low[:, :bands], 2 * side + 1) + high[:, :bands], 2 * side + 70)
            if side:
                keys = _mix(keys + np.where(even, low[:, bands + shared], high[:, bands + shared]), 90)
            counts.append(pa.array(lengths.astype(np.int32)))
            bits += [pa.array(x.view(np.int64)) for x in _parity(elements, lengths, BITMAPS[side])]
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * bands, bands, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
        mask = pa.array(full)
        kept = [batch.column(c).filter(mask) for c in ("id", "delivery_id")]
        columns = [*kept, *(pa.array(c.view(np.int64)) for c in cls), *counts, *bits, listed]
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SIGNED.split(", ")])


def _keep(df: DataFrame, label: str) -> DataFrame:
    return workspace.keep(df, label, tidy=True)


def _few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows, of a few numbers each, are few enough; else as it is."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def signatures(comments: DataFrame, bands: int = BANDS) -> DataFrame:
    """The ``SIGNED`` columns of each comment's surviving delivery, if it has words in both fields.

    The deliveries that lose are taken out where the texts are read, so texts aren't shuffled.
    """
    stamped = comments.where("id is not null").select("id", instant_us(F.col("updated_at")).alias("at_us"), "delivery_id")
    won = stamped.groupBy("id").agg(F.max(preference(F.col("at_us"), F.col("delivery_id"))).alias("best"))
    lost = stamped.select("delivery_id").join(won.select((-F.col("best.order")).alias("delivery_id")), "delivery_id", "left_anti")
    lost = _keep(lost, "lost")
    texts = comments.where("id is not null").select("id", "delivery_id", "body", "diff_hunk")
    kept = texts.join(_few(lost), "delivery_id", "left_anti").select("id", "delivery_id", "body", "diff_hunk")
    return kept.mapInArrow(lambda it: _signed(it, bands), SIGNED)


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        out = [batch.column("id")]
        for c in ("body", "diff_hunk"):
            elements, lengths = bags(batch.column(c).to_pylist(), hashes)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(elements.view(np.int64))))
        yield pa.RecordBatch.from_arrays(out, names=["id", "body_bag", "hunk_bag"])


def _alike(a: str, b: str) -> F.Column:
    shared = F.size(F.array_intersect(a, b))
    return shared * 5 >= FIFTHS * F.greatest(F.size(a), F.size(b))


def _fits(n_a: str, n_b: str) -> F.Column:
    """Whether bags of these sizes can share four fifths of the longer one."""
    return F.least(n_a, n_b) * 5 >= FIFTHS * F.greatest(n_a, n_b)


def _bags_of(comments: DataFrame, single: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """(id, body_bag, hunk_bag) of the classes with these identifiers; only the small side is shuffled if it is small."""
    wanted = _keep(single.select("id", "delivery_id").join(ids, "id", "left_semi"), "wanted")
    texts = comments.select("delivery_id", "body", "diff_hunk").join(_few(wanted), "delivery_id").dropDuplicates(["delivery_id"])
    made = texts.select("id", "body", "diff_hunk").mapInArrow(_bagged, "id bigint, body_bag array<bigint>, hunk_bag array<bigint>")
    return _keep(made, label)


def prefix_pairs(bag: DataFrame, most: int | None = None) -> DataFrame | None:
    """(a, b), a < b: pairs among the given bags that prefix filtering can't rule out; no similar pair is missing.
    None if that takes at least ``most`` meetings.

    An element's count combines on the map side, and the few common ones are broadcast, so no element's
    rows meet in one task before the search itself.
    """
    flat = bag.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).alias("bag")) for k, c in ((0, "body_bag"), (1, "hunk_bag"))])).alias("s"))
    flat = flat.select("id", "s.side", F.size("s.bag").alias("n"), F.explode("s.bag").alias("element"))
    counts = _keep(flat.groupBy("side", "element").agg(F.count("*").alias("often")), "elements")
    total = counts.agg(F.sum("often").alias("t")).first().t or 0
    common = F.broadcast(counts.where(F.col("often") >= max(total / COMMON, 2)))
    rest = flat.join(common, ["side", "element"], "left_anti").join(counts.where(F.col("often") < max(total / COMMON, 2)), ["side", "element"])
    counted = flat.join(common, ["side", "element"]).unionByName(rest)
    at = F.row_number().over(W.partitionBy("id", "side").orderBy("often", "element"))  # one text's elements
    first = _keep(counted.withColumn("at", at).where("at <= n div 5 + 1").drop("at"), "prefixes")
    cost = first.groupBy("id", "side").agg(F.sum("often").alias("cost")).groupBy("id").agg(F.min(F.struct("cost", "side")).alias("c"))
    probe = first.join(cost.select("id", F.col("c.side").alias("side")), ["id", "side"])
    if most is not None:
        looks = _keep(probe.groupBy("side", "element").agg(F.count("*").alias("m")), "looks")
        met_by = looks.join(first.groupBy("side", "element").agg(F.count("*").alias("n")), ["side", "element"])
        if (_keep(met_by, "meetings").agg(F.sum(F.col("m") * F.col("n")).alias("t")).first().t or 0) >= most:
            return None
    one, two = probe.select("side", "element", F.col("id").alias("p"), F.col("n").alias("n_p")), first.select("side", "element", F.col("id").alias("q"), F.col("n").alias("n_q"))
    met = one.join(two, ["side", "element"]).where(_fits("n_p", "n_q") & (F.col("p") != F.col("q")))
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows twice, for a pair's two sides: ``id`` is a or b, sketches have the side's letter at the end."""
    return tuple(rows.toDF(*(x if c == "id" else c if c == "key" else f"{c}_{x}" for c in rows.columns)) for x in "ab")


def _possible() -> F.Column:
    """Whether the lengths and bitmaps of a pair's two sides leave it possible that they are alike."""
    found = F.lit(True)
    for field, words in zip(("body", "hunk"), PARITY, strict=True):
        differ = sum(F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words)
        n_a, n_b = f"{field}_n_a", f"{field}_n_b"
        found = found & _fits(n_a, n_b) & ((F.col(n_a) + F.col(n_b) - differ) * 5 >= 2 * FIFTHS * F.greatest(n_a, n_b))
    return found


def _hot_pairs(single: DataFrame, comments: DataFrame, hot: DataFrame) -> DataFrame | None:
    """(a, b): what a prefix search among the members of hot bands finds; None if joining the bands takes fewer meetings."""
    within = single.select(F.explode("bands").alias("key"), "id").join(_few(hot), "key", "left_semi")
    shared = _keep(within.groupBy("key").agg(F.count("*").alias("n")), "hot-counts")
    joined = shared.agg(F.sum(F.expr("n * (n - 1) div 2")).alias("t")).first().t or 0
    members = _keep(within.select("id").distinct(), "members")
    every = max(1, members.count() // HOT_TRIED)
    if every > 1:  # meetings grow with the square of the members
        some = members.where(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(every)) == 0)
        if prefix_pairs(_bags_of(comments, single, some, "hot-bags"), max(1, joined // every**2)) is None:
            return None
    return prefix_pairs(_bags_of(comments, single, members, "hot-bags"), joined)


def candidates_of(single: DataFrame, comments: DataFrame) -> DataFrame:
    """(a, b), a < b: the classes that share a band, those of hot bands by :func:`prefix_pairs` if that takes
    less, and whose lengths and bitmaps leave it possible that they are alike."""
    sketch = ["id", "body_n", "hunk_n", *PARITY[0], *PARITY[1]]
    sample = single.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(HOT_SAMPLE)) == 0).select(F.explode("bands").alias("key"))
    hot = _keep(sample.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_SEEN).select("key"), "hot")
    hot_pairs = None if hot.isEmpty() else _hot_pairs(single, comments, hot)
    found = []
    if hot_pairs is not None:
        a, b = _sides(single.select(sketch))
        found.append(_keep(hot_pairs.join(a, "a").join(b, "b").where(_possible()).select("a", "b"), "near"))
    for k in range(0, BANDS, SLICE):
        keys = single.select(F.explode(F.slice("bands", k + 1, SLICE)).alias("key"), *sketch)
        if hot_pairs is not None:
            keys = keys.join(_few(hot), "key", "left_anti")
        a, b = _sides(keys)
        found.append(_keep(a.join(b, "key").where((F.col("a") < F.col("b")) & _possible()).select("a", "b"), "near"))
    return reduce(DataFrame.unionByName, found).distinct()


def near_pairs(comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, classes): verified pairs (rep_a, rep_b) of representatives, and (id, rep) of all comments
    with words in both fields."""
    signed = _keep(signatures(comments), "signatures")
    reps = signed.groupBy("cls_a", "cls_b").agg(F.min("id").alias("rep"))
    named = signed.select("id", "cls_a", "cls_b").join(reps, ["cls_a", "cls_b"])
    classes = _keep(named.select("id", "rep").distinct(), "classes")
    copies = _keep(classes.where("id <> rep").select("id"), "copies")
    single = signed
    if not copies.isEmpty():
        single = _keep(signed.join(_few(copies), "id", "left_anti"), "single")
        workspace.forget(signed)
    near = _keep(candidates_of(single, comments), "near")  # rows may be repeated

    bag = _bags_of(comments, single, near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "bags")
    measured = near.join(bag.toDF("a", "body_a", "hunk_a"), "a").join(bag.toDF("b", "body_b", "hunk_b"), "b")
    alike = measured.where(_alike("body_a", "body_b") & _alike("hunk_a", "hunk_b"))
    return _keep(alike.select(F.col("a").alias("rep_a"), F.col("b").alias("rep_b")), "pairs"), classes


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b: each pair of comments with alike bodies and hunks."""
    pairs, classes = near_pairs(workspace.load(spark, sf_dir, "review_comments"))
    many = classes.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep")
    copies = classes.join(many, "rep", "left_semi").select("id", "rep")
    a, b = classes.toDF("id_a", "rep_a"), classes.toDF("id_b", "rep_b")
    across = pairs.join(a, "rep_a").join(b, "rep_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    within = copies.toDF("id_a", "rep").join(copies.toDF("id_b", "rep"), "rep").where("id_a < id_b").select("id_a", "id_b")
    return across.unionByName(within)


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id, links): each comment's group of near-duplicates and its number of similar classes.

    Groups are the connected components of the similar pairs; a comment like no other is alone.
    """
    from hunkmill.llm.splits import contract

    pairs, classes = near_pairs(workspace.load(spark, sf_dir, "review_comments"))
    nodes, _ = contract(pairs.select(F.col("rep_a").alias("u"), F.col("rep_b").alias("v")))
    label = nodes.groupBy("root").agg(F.min("node").alias("group_id"))
    links = pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    grouped = nodes.join(label, "root").select(F.col("node").alias("rep"), "group_id").join(links, "rep", "left")
    return classes.join(grouped, "rep", "left").select(
        "id", F.coalesce("group_id", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links")
    )


P4_SQL = r"""with kept as (select id, body, diff_hunk from review_comments where id is not null
    qualify row_number() over (partition by id order by cast(updated_at as timestamptz) desc nulls last, delivery_id) = 1),
words as (select id, 'b' as side, unnest(regexp_extract_all(lower(body), '[\p{L}\p{N}]+')) as w from kept
    union all select id, 'h', unnest(regexp_extract_all(lower(diff_hunk), '[\p{L}\p{N}]+')) from kept),
els as (select id, side, w, row_number() over (partition by id, side, w) as k, count(*) over (partition by id, side) as n from words),
hunks as (select a.id as id_a, b.id as id_b from els a join els b on a.side = 'h' and b.side = 'h' and a.w = b.w and a.k = b.k and a.id < b.id
    and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) group by a.id, b.id, a.n, b.n having 5 * count(*) >= 4 * greatest(a.n, b.n)),
bodies as (select h.id_a, h.id_b from hunks h join els a on a.id = h.id_a and a.side = 'b' join els b on b.id = h.id_b and b.side = 'b' and a.w = b.w and a.k = b.k
    group by h.id_a, h.id_b, a.n, b.n having 5 * count(*) >= 4 * greatest(a.n, b.n))
select id_a, id_b from bodies
"""
