import json

import pytest

from hunkmill import schemas
from hunkmill.operators import shards
from hunkmill.sources import forge, jsonl


@pytest.mark.parametrize(
    "status, headers, waits, action, seconds",
    [
        (200, {"x-ratelimit-remaining": "5"}, 0, "ok", 0),
        (200, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "130"}, 0, "ok", 31),
        (429, {"Retry-After": "7"}, 0, "wait", 7),
        (429, {"x-ratelimit-reset": "110"}, 4, "wait", 11),
        (429, {"Retry-After": "7"}, 5, "fail", 0),
        (403, {"x-ratelimit-remaining": "0", "x-ratelimit-reset": "90"}, 0, "wait", 1),
        (403, {"x-ratelimit-remaining": "3"}, 0, "fail", 0),
        (502, {}, 3, "wait", 8),
        (502, {}, 5, "fail", 0),
        (404, {}, 0, "fail", 0),
    ],
)
def test_decision_table(status, headers, waits, action, seconds):
    step = forge.next_step(status, headers, "x" * 999, waits, 100.0)
    assert (step.action, step.seconds) == (action, seconds)
    assert len(step.message) < 330


def test_crawl_follows_links_and_stops():
    pages = {
        "u1": (200, {"Link": '<u2>; rel="next"'}, '[{"id": 1}, {"id": 2}]'),
        "u2": (200, {"Link": '<u3>; rel="next"'}, '[{"id": 3}]'),
        "u3": (200, {"Link": '<u4>; rel="next"'}, "[]"),
    }
    slept = []
    assert [r["id"] for r in forge.crawl(pages.__getitem__, "u1", slept.append, lambda: 0.0)] == [1, 2, 3]
    assert [r["id"] for r in forge.crawl(pages.__getitem__, "u1", slept.append, lambda: 0.0, limit=1)] == [1, 2]
    with pytest.raises(OSError):
        list(forge.crawl(lambda u: (404, {}, "gone"), "u", slept.append, lambda: 0.0))


def test_windows():
    assert shards.windows(0, 10, 3) == [(0, 3), (3, 6), (6, 10)]
    assert shards.windows(0, 2, 4) == [(0, 1), (1, 2), (2, 2), (2, 2)]
    for n in (1, 2, 7):
        cuts = shards.windows(5, 50, n)
        assert cuts[0][0] == 5 and cuts[-1][1] == 50 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))


ROWS = [{"id": k, "updated_at": forge.stamp(1_700_000_000 + 60 * k), "body": f"b{k}", "user": {"login": "x", "id": 1}, "extra": 1} for k in range(50)]


def test_source_reads_each_row_once_in_windows(spark, tmp_path):
    forge.write_pages(ROWS, str(tmp_path), 7)
    forge.register(spark)
    for workers in (1, 3, 8):
        df = spark.read.format("forge_comments").option("pages", str(tmp_path)).option("workers", workers).load()
        assert sorted(r.id for r in df.collect()) == list(range(50))
    cut = ROWS[20]["updated_at"]
    got = spark.read.format("forge_comments").option("pages", str(tmp_path)).option("since", cut).load()
    assert sorted(r.id for r in got.collect()) == list(range(20, 50))
    assert got.where(f"updated_at < '{ROWS[30]['updated_at']}'").count() == 10
    assert got.first().user.login == "x"


def test_stream_resumes_from_its_mark(spark, tmp_path):
    pages, out = str(tmp_path / "p"), str(tmp_path / "o")
    forge.register(spark)

    def run(per_batch):
        s = spark.readStream.format("forge_comments").option("pages", pages).option("pages_per_batch", per_batch).load()
        q = s.writeStream.format("json").option("checkpointLocation", str(tmp_path / "c")).start(out)
        q.processAllAvailable()
        batches = [p.batchId for p in q.recentProgress if p.numInputRows]
        q.stop()
        return sorted(r.id for r in spark.read.schema(schemas.REVIEW_COMMENT).json(out).collect()), len(batches)

    forge.write_pages(ROWS[:20], pages, 5)
    ids, batches = run(100)
    assert ids == list(range(20)) and batches == 1
    forge.write_pages(ROWS, pages, 5)
    ids, batches = run(2)
    assert set(ids) == set(range(50)) and batches == 3
    assert len(ids) == 50 + 3  # the row at each mark comes twice


def test_resume_marks(tmp_path):
    out = str(tmp_path / "x" / "comments.jsonl")
    assert forge.resume_mark(None, out) is None and forge.resume_mark(" 2024 ", out) == "2024"
    forge.save_checkpoint(out, "2023-05-06T00:00:00Z\n")
    assert (tmp_path / "x" / "comments.checkpoint").exists()
    assert forge.resume_mark(None, out) == "2023-05-06T00:00:00Z" and forge.resume_mark("2024", out) == "2024"
    assert forge.resume_mark(" ", out) is None
    forge.save_checkpoint(out, None)
    assert forge.resume_mark(None, out) is None


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 2, "body": "x"}\n\n{"id": 1}\n')
    (tmp_path / "b.jsonl").write_text('{"id": 9, "unknown": 3}\n{"id": \n')
    paths = [str(tmp_path / n) for n in ("a.jsonl", "b.jsonl")]
    rows = jsonl.scan(spark, paths, schemas.REVIEW_COMMENT, strict=False).orderBy("file_idx", "offset").collect()
    assert [r.id for r in rows[:3]] == [2, 1, 9] and rows[3]._bad is not None
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.scan(spark, paths, schemas.REVIEW_COMMENT).collect()
    assert jsonl.scan(spark, paths[:1], schemas.REVIEW_COMMENT).count() == 2


def test_atomic_replacement(spark, tmp_path):
    path = str(tmp_path / "store")
    for n in (1, 2):
        jsonl.replace_atomically(spark.range(n), path)
        assert spark.read.json(path).count() == n
    assert [p.name for p in tmp_path.iterdir()] == ["store"]
    # a writer that ended between its renames
    (tmp_path / "store").rename(tmp_path / "store.old")
    assert jsonl.current(spark, path) == path + ".old"
    assert spark.read.json(jsonl.current(spark, path)).count() == 2
    jsonl.replace_atomically(spark.range(3), path)
    assert jsonl.current(spark, path) == path and spark.read.json(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["store"]


def test_curate_files(spark, tmp_path):
    from hunkmill.plans import pipelines

    base = {"pull_request_url": "https://h/repos/o/n/pulls/3", "path": "p", "diff_hunk": "@@", "created_at": "", "updated_at": "", "user": {"login": "u"}}
    rows = [
        base | {"id": 1, "body": "Why not keep this invariant in the interface instead of here?"},
        base | {"id": 2, "body": "reply", "in_reply_to_id": 1}, base | {"id": 2, "body": "reply", "in_reply_to_id": 1},
        base | {"id": 3, "body": "x" * 30, "user": {"login": "y[bot]"}}, base | {"id": 4, "body": "y" * 30, "path": None},
        base | {"id": 5, "body": "thanks, this design is fine by me"}, base | {"id": 6, "body": "z" * 30}, base | {"id": 7, "body": "typo", "user": None},
    ]
    src, out = tmp_path / "in.jsonl", str(tmp_path / "out")
    src.write_text("\n".join(map(json.dumps, rows)))
    counts = pipelines.curate_files(spark, [str(src)], out, 0.4)
    assert counts == {"seen": 8, "dup": 1, "reply": 1, "bot": 1, "no_diff": 1, "trivial": 2, "low_score": 1, "kept": 1}
    kept = spark.read.schema(schemas.CHAT_RECORD).json(out).collect()
    assert [(r.meta.source_id, r.meta.reply_count, r.meta.category) for r in kept] == [(1, 2, "design")]


def test_review_run(spark):
    from hunkmill.plans import pipelines
    from tests.test_diffs import SAMPLE

    diff = spark.createDataFrame([(1, SAMPLE)], "doc int, diff string")
    made, calls = pipelines.review(diff, "o/n", 3, "s", "t")
    rows = {r.path: r for r in made.collect()}
    assert rows["src/lib.rs"].cited_line == 11 and rows["src/lib.rs"].grounded and calls.count() == 2

    class Echo:
        model_version = "echo"

        def review(self, prompt):
            return ["one", "two"] if "lib.rs" in prompt else []

    made, calls = pipelines.review(diff, "o/n", 3, "s", "t", Echo)
    assert sorted(r.critic_comment for r in made.collect()) == ["one", "two"]
    assert {r.status for r in calls.collect()} == {"ok"}


def test_pages_hold_rows_with_any_form_of_time(spark):
    from pyspark.sql import functions as F

    from hunkmill.operators import scans

    forge.register(spark)
    times = ["2024-01-01T00:00:00Z", "2024-01-01T01:30:00+02:00", "2023-12-31T23:00:00.000Z", "2023-12-31T20:00:00-05:00", "2024-01-01T02:00:00.250Z", None]
    whole = ["2024-01-01T00:00:00Z", "2023-12-31T23:30:00Z", "2023-12-31T23:00:00Z", "2024-01-01T01:00:00Z", "2024-01-01T02:00:00.25Z", None]
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.REVIEW_COMMENT.fields if f.name not in ("id", "updated_at")]
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(times)], "id bigint, delivery_id bigint, updated_at string").select("*", *blank)
    for size in (2, 100):
        pages = scans.forge_pages(rows, size)
        for workers in (1, 3):
            df = spark.read.format("forge_comments").option("pages", pages).option("workers", workers).load()
            assert sorted((r.id, r.updated_at) for r in df.collect()) == list(enumerate(whole))
    window = spark.read.format("forge_comments").option("pages", pages).option("since", "2023-12-31T23:30:00Z").option("workers", 2).load()
    assert sorted(r.id for r in window.where("updated_at < '2024-01-01T01:00:00Z'").collect()) == [0, 1]
    table = spark.read.parquet("/root/testdata/sf0.001/review_comments.parquet")
    df = spark.read.format("forge_comments").option("pages", scans.forge_pages(table, 50)).option("workers", 4).load()
    assert (df.count(), df.where("updated_at not rlike '^[0-9T:-]{19}Z$'").count()) == (200, 0)
