import random
import re
import time
from collections import Counter

import numpy as np

from hunkmill.llm import neardup

SCHEMA = "id bigint, delivery_id bigint, updated_at string, body string, diff_hunk string, key string, rep int"
WORD = re.compile(r"[^\W_]+")


def bag(t):
    return Counter(WORD.findall((t or "").casefold()))


def alike(a, b):
    return 5 * sum((a & b).values()) >= 4 * max(sum(a.values()), sum(b.values()))


def brute(rows):
    best = {}
    for i, d, at, b, h, *_ in rows:
        if i is not None and (i not in best or (at or "", -d) > best[i][0]):
            best[i] = ((at or "", -d), bag(b), bag(h))
    ids = sorted(i for i, (_, b, h) in best.items() if b and h)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if alike(best[a][1], best[b][1]) and alike(best[a][2], best[b][2])}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + rng.randint(0, 1)] = rng.choice([[], [f"w{rng.randint(0, 999)}"], [words[k]]])
    rng.shuffle(words) if n and rng.random() < 0.2 else None
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    rows, d = [], 0
    for base in range(40):
        b, h = " ".join(rng.choices(vocab, k=rng.randint(3, 40))), " ".join(rng.choices(vocab, k=rng.randint(5, 60)))
        for _ in range(rng.randint(1, 6)):
            d += 1
            rows.append((d if rng.random() < 0.9 else None, d, "2024-01-01T00:00:00Z", edited(rng, b, rng.randint(0, 5)), edited(rng, h, rng.randint(0, 6)), "clash", 3))
    rows += [(9000, 9000, None, "Thanks!", rows[0][4], "", 0), (9001, 9001, "2024-01-01T00:00:00Z", "THANKS", rows[0][4] + " !!", "", 0)]
    rows += [(9002, 9002, None, None, "x y", "", 0), (9003, 9003, None, "..", "x y", "", 0), (9004, 9004, None, "", "", "", 0)]
    rows += [(rows[1][0], 9100, "2025-01-01T00:00:00Z", "other words entirely here", rows[1][4], "", 0)]
    return rows


def found(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, SCHEMA)
    out = neardup.p4_found.__globals__["workspace"]
    original = out.load
    out.load = lambda *_: df
    try:
        return [(r.id_a, r.id_b) for r in neardup.p4_found(spark, "").collect()]
    finally:
        out.load = original


def test_pairs_against_brute_force(spark):
    missed = total = 0
    for seed in range(3):
        rows = corpus(seed)
        got = found(spark, rows + rows[:10])
        assert len(got) == len(set(got))
        expected = brute(rows)
        assert set(got) <= expected
        missed, total = missed + len(expected - set(got)), total + len(expected)
    assert total > 100 and missed <= 0.01 * total


def test_hot_group_of_copies_is_one_class(spark):
    rows = [(k, k, "2024-01-01T00:00:00Z", "the same body again and again", "@@ same hunk of code @@", "", 0) for k in range(300)]
    rows += [(1000, 1000, "2024-01-01T00:00:00Z", "the same body again and once", "@@ same hunk of code @@", "", 0)]
    pairs, classes = neardup.near_pairs(spark.createDataFrame(rows, SCHEMA))
    assert classes.count() == 301 and pairs.count() == 1


def test_empty_and_long(spark):
    assert found(spark, []) == []
    long = " ".join(f"w{k % 7919}" for k in range(200_000))
    rows = [(1, 1, None, long, "h k l", "", 0), (2, 2, None, long + " more", "h k l", "", 0)]
    assert found(spark, rows) == [(1, 2)]


def test_minmax_signatures_estimate_jaccard():
    rng = np.random.default_rng(0)
    a, b = (set(rng.choice(3000, 900, replace=False).tolist()) for _ in range(2))
    b = set(list(a)[:700]) | set(list(b)[:200])
    jaccard = len(a & b) / len(a | b)
    permutations = neardup._permutations(400)
    rows = [neardup._minmax(neardup._mix(np.array(sorted(s), np.uint64), 3), np.array([len(s)]), permutations) for s in (a, b)]
    agree = np.mean([x == y for i in (0, 1) for x, y in zip(rows[0][i][0], rows[1][i][0], strict=True)])
    assert abs(agree - jaccard) < 0.06


def hot_hunk(n, seed):
    """Many bodies on one hunk, short ones too; a tenth repeat another body with an edit."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(2000)] + ["the", "a", "is", "this"] * 200
    bodies = []
    for k in range(n):
        if bodies and rng.random() < 0.1:
            bodies.append(edited(rng, rng.choice(bodies), 1))
        else:
            bodies.append(" ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 6, 8, 15, 30]))))
    hunk = " ".join(f"h{k}" for k in range(60))
    return [(k, k, "2024-01-01T00:00:00Z", b or "w0", hunk if k % 3 else hunk + f" line{k % 5}", "", 0) for k, b in enumerate(bodies)]


def test_hot_hunk_is_searched_by_prefixes_and_completely(spark, monkeypatch):
    rows = hot_hunk(5000, 3)
    taken = {}
    searched, keep = {name: getattr(neardup, name) for name in ("prefix_pairs", "candidates_of")}, neardup.workspace.keep

    def counted(name):
        def run(given, *more):
            out = keep(searched[name](given, *more), "counted")
            taken[name] = given.count(), out.count()
            return out

        return run

    for name in searched:
        monkeypatch.setattr(neardup, name, counted(name))
    pairs, classes = neardup.near_pairs(spark.createDataFrame(rows, SCHEMA))
    assert taken["prefix_pairs"][0] > 300 and taken["candidates_of"][1] < 40 * taken["candidates_of"][0]  # of 12 million pairs
    rep = {r.id: r.rep for r in classes.collect()}
    got = {(r.rep_a, r.rep_b) for r in pairs.collect()}
    # brute force by shared rare words: bodies of like length that share four fifths
    bags, index, expected = {k: bag(b) for k, _, _, b, *_ in rows if rep[k] == k}, {}, set()
    for k, b in bags.items():
        for w in b:
            index.setdefault(w, set()).add(k)
    hunks = {k: bag(h) for k, _, _, _, h, *_ in rows}
    for k, b in bags.items():
        near = Counter(o for w in b if len(index[w]) < 600 for o in index[w] if o > k)
        expected |= {(k, o) for o in near if 5 * sum((b & bags[o]).values()) >= 4 * max(sum(b.values()), sum(bags[o].values())) and alike_bags(hunks[k], hunks[o])}
    assert got <= expected | got and len(expected - got) <= 0.01 * len(expected) and len(expected) > 200


def alike_bags(a, b):
    return 5 * sum((a & b).values()) >= 4 * max(sum(a.values()), sum(b.values()))


def test_prefix_search_misses_nothing(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"v{k}" for k in range(12)], k=rng.randint(1, 9))) for _ in range(200)]
    rows = [(k, k, None, t, "h1 h2 h3", "", 0) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    bags_ = df.select("id", "body", "diff_hunk").mapInArrow(neardup._bagged, "id bigint, body_bag array<bigint>, hunk_bag array<bigint>")
    met = {(r.a, r.b) for r in neardup.prefix_pairs(bags_).collect()}
    want = {(a, b) for a in range(200) for b in range(a + 1, 200) if alike_bags(bag(texts[a]), bag(texts[b]))}
    assert want <= met and want


def test_parity_bitmaps_bound_what_bags_share():
    rng = np.random.default_rng(4)
    for n, m, shared in ((3, 4, 3), (20, 25, 18), (200, 220, 170), (1500, 1500, 1200)):
        pool = rng.integers(0, 2**63, n + m - shared, dtype=np.uint64)
        a, b = pool[:n], pool[n - shared :]
        for bits in neardup.BITMAPS:
            words = [neardup._parity(x, np.array([len(x)]), bits) for x in (a, b)]
            differ = sum(int(x[0] ^ y[0]).bit_count() for x, y in zip(*words, strict=True))
            assert n + m - differ >= 2 * shared


def test_chance_meetings_of_a_stock_body_are_not_written(spark, monkeypatch):
    rng = random.Random(5)
    hunks = [" ".join(rng.choices([f"v{k}" for k in range(40)], k=12)) for _ in range(600)]
    hunks += [edited(rng, h, 1) for h in hunks[:60]]
    rows = [(k, k, "2024-01-01T00:00:00Z", "Good point, changed.", h, "", 0) for k, h in enumerate(hunks)]
    search, written = neardup.candidates_of, []

    def counted(*given):
        out = neardup.workspace.keep(search(*given), "counted")
        written.append(out.count())
        return out

    monkeypatch.setattr(neardup, "candidates_of", counted)
    got, expected = set(found(spark, rows)), brute(rows)
    assert got <= expected and len(expected - got) <= 0.01 * len(expected) and len(expected) >= 40
    assert written[0] <= 2 * len(expected)  # of some 50,000 pairs that share a band


def test_prefix_search_is_left_if_it_meets_more_than_the_bands(spark):
    rows = [(k, [1, 2, k % 5], [3, 4, k % 7]) for k in range(100)]
    bag_ = spark.createDataFrame(rows, "id bigint, body_bag array<bigint>, hunk_bag array<bigint>")
    assert neardup.prefix_pairs(bag_, 1) is None
    assert neardup.prefix_pairs(bag_, 10**6).count() == neardup.prefix_pairs(bag_).count() > 0


def test_tidy_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(filter(lambda b: b.startswith("shuffle_"), disk.getAllBlocks().mkString(" ").split()))

    before, setting = shuffled(), spark.conf.get(neardup.workspace.TIDY, None)
    kept = neardup.workspace.keep(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "sums", tidy=True)
    for _ in range(50):  # the files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before and spark.conf.get(neardup.workspace.TIDY, None) == setting
    assert kept.count() == 7
