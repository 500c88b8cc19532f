import random
from datetime import datetime

from hunkmill import workspace
from hunkmill.operators.deliveries import DeliveryLedger, keep_latest, latest_deliveries

SCHEMA = "id bigint, delivery_id bigint, updated_at string, ingested_at timestamp, at_us string, home int"


def rows_of(n, ids, seed=0):
    rng = random.Random(seed)
    stamps = ["2024-01-01T00:00:00Z", "2024-01-01T03:00:00+03:00", "2024-01-01T00:00:00.000Z", "2023-12-31T23:00:00-02:00", None, "garbage"]
    return [
        (rng.choice([None, *range(ids)]) if rng.random() < 0.7 else 0, k, rng.choice(stamps), datetime(2024, rng.randint(1, 6), 1), "clash", 1)
        for k in range(1, n + 1)
    ]


def instant(s):
    try:
        return datetime.fromisoformat(s.replace("Z", "+00:00")).timestamp()
    except (AttributeError, ValueError):
        return float("-inf")


def brute(rows):
    best = {}
    for i, d, s, *_ in rows:
        if i is not None and (i not in best or (instant(s), -d) > best[i]):
            best[i] = (instant(s), -d)
    return {i: -d for i, (_, d) in best.items()}


def test_latest_against_brute_force(spark):
    rows = rows_of(400, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.id: r.delivery_id for r in latest_deliveries(df).collect()} == brute(rows)
    kept = [r.delivery_id for r in keep_latest(df.unionByName(df.limit(50))).where("id is not null").collect()]
    assert sorted(kept) == sorted(brute(rows).values())


def test_ledger_in_batches_equals_one_pass(spark):
    rows = rows_of(500, 40, 1)
    ledger = DeliveryLedger(spark, workspace.scratch_path(spark, "t"))
    assert ledger.winners().count() == 0
    for k in range(0, 500, 120):
        ledger.ingest(spark.createDataFrame(rows[k : k + 120], SCHEMA), "id", "delivery_id", "updated_at", "ingested_at")
    expected = brute(rows)
    assert {r.id: r.delivery_id for r in ledger.winners().collect()} == expected
    gone = {(i, d) for i, d, *_ in rows if i is not None and expected[i] != d}
    assert {(r.id, r.delivery_id) for r in ledger.removed().collect()} == gone
    # again: nothing changes
    ledger.ingest(spark.createDataFrame(rows[:120], SCHEMA), "id", "delivery_id", "updated_at", "ingested_at")
    assert {r.id: r.delivery_id for r in ledger.winners().collect()} == expected
    assert {(r.id, r.delivery_id) for r in ledger.removed().collect()} == gone


def test_only_affected_partitions_are_rewritten(spark):
    ledger = DeliveryLedger(spark, workspace.scratch_path(spark, "t"))
    first = [(k, k, "2024-01-01T00:00:00Z", datetime(2024, k, 1), "", 0) for k in range(1, 5)]
    ledger.ingest(spark.createDataFrame(first, SCHEMA), "id", "delivery_id", "updated_at", "ingested_at")
    before = ledger.manifest()["parts"]
    late = [(2, 9, "2024-02-01T00:00:00Z", datetime(2024, 9, 1), "", 0), (7, 10, "2024-02-01T00:00:00Z", datetime(2024, 9, 1), "", 0)]
    assert ledger.ingest(spark.createDataFrame(late, SCHEMA), "id", "delivery_id", "updated_at", "ingested_at") == [2024 * 12 + 1]
    after = ledger.manifest()["parts"]
    changed = {p for p in after if before.get(p) != after[p]}
    assert changed == {str(2024 * 12 + 1), str(2024 * 12 + 8)}
    assert {r.id: r.delivery_id for r in ledger.winners().collect()} == {1: 1, 2: 9, 3: 3, 4: 4, 7: 10}
    assert ledger.ingest(spark.createDataFrame([], SCHEMA), "id", "delivery_id", "updated_at", "ingested_at") == []
    assert ledger.winners().count() == 5


def test_two_writers_lose_no_batch(spark):
    """Both read the same version; the second to publish repeats its merge."""
    import threading

    rows = rows_of(300, 40, 3)
    path = workspace.scratch_path(spark, "t")
    together, failed = threading.Barrier(2, timeout=120), []

    class Slow(DeliveryLedger):
        waited = False

        def _publish(self, manifest):
            if not self.waited:
                self.waited = True
                together.wait()
            super()._publish(manifest)

    def write(part):
        try:
            Slow(spark, path).ingest(spark.createDataFrame(part, SCHEMA), "id", "delivery_id", "updated_at", "ingested_at")
        except Exception as e:
            failed.append(e)

    writers = [threading.Thread(target=write, args=(part,)) for part in (rows[:150], rows[150:])]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    ledger = DeliveryLedger(spark, path)
    assert failed == [] and ledger.manifest()["version"] == 2
    expected = brute(rows)
    assert {r.id: r.delivery_id for r in ledger.winners().collect()} == expected
    assert {(r.id, r.delivery_id) for r in ledger.removed().collect()} == {(i, d) for i, d, *_ in rows if i is not None and expected[i] != d}


def test_many_commits_leave_few_folders_and_a_batch_reads_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(DeliveryLedger, "FAN_IN", 3)
    ledger = DeliveryLedger(spark, workspace.scratch_path(spark, "t").removeprefix("file://"))  # the default file system's
    rows = rows_of(160, 30, 5)
    for k in range(0, 160, 20):
        ledger.ingest(spark.createDataFrame(rows[k : k + 20], SCHEMA), "id", "delivery_id", "updated_at", "ingested_at")
        now = ledger.manifest()
        assert max(len(now["index"]), len(now["removed"])) <= 5 and max(map(len, now["parts"].values())) <= 3
    assert {r.id: r.delivery_id for r in ledger.winners().collect()} == brute(rows)
    read = []
    monkeypatch.setattr(ledger, "_read", lambda paths, schema: read.extend(paths) or DeliveryLedger._read(ledger, paths, schema))
    ledger.ingest(spark.createDataFrame(rows[:1], SCHEMA).selectExpr("7L as id", "delivery_id", "updated_at", "ingested_at"), "id", "delivery_id", "updated_at", "ingested_at")
    assert len({p.split("bucket=")[1] for p in read if "bucket=" in p}) == 1
