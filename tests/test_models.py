import json
import math
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hunkmill.functions import vectors as V
from hunkmill.operators import critics, evaluation, hybrid
from hunkmill.operators.limiter import Limiter, fold
from hunkmill.plans import pipelines
from hunkmill.sources import models


def settle(limiter, rounds, rtt):
    for _ in range(rounds):
        limiter.success(rtt(limiter.limit))
    return limiter.limit


def test_limiter():
    knee = lambda n: 0.05 * max(n / 8, 1)
    assert settle(Limiter(1, 32, 2), 800, knee) == 11
    x = Limiter(1, 32, 16)
    x.error()
    assert x.limit == 12
    assert settle(Limiter(1, 6, 2), 200, lambda n: 0.01) == 6
    assert settle(Limiter(1, 32, 1), 3, lambda n: 0.01) > 1


def test_fold_equals_the_class(spark):
    rng = np.random.default_rng(2)
    answers = [(float(abs(r)), bool(ok)) for r, ok in zip(rng.normal(0.1, 0.05, 300), rng.random(300) < 0.8, strict=True)]
    limiter = Limiter(1, 32, 2)
    for r, ok in answers:
        limiter.success(r) if ok else limiter.error()
    df = spark.createDataFrame([([{"rtt": r, "ok": ok} for r, ok in answers],)], "a array<struct<rtt: double, ok: boolean>>")
    assert df.select(fold(F.col("a"))["limit"].alias("x")).first().x == pytest.approx(limiter.limit_)


def test_calls_keep_order_retry_and_survive():
    tries, lock = {}, threading.Lock()

    def call(p):
        with lock:
            tries[p] = tries.get(p, 0) + 1
        if p == "bad":
            raise critics.CallError("no")
        if p == "busy" and tries[p] == 1:
            raise critics.CallError("429", overload=True)
        return p.upper()

    out = critics.run_calls(["a", "bad", "busy", "z"], call, Limiter(1, 4, 2), sleep=lambda s: None)
    assert out == [("ok", "A"), ("failed", "no"), ("ok", "BUSY"), ("ok", "Z")]
    assert tries == {"a": 1, "bad": 2, "busy": 2, "z": 1}
    assert critics.run_calls([], call, Limiter()) == []


def test_a_server_gets_no_more_calls_than_its_limit():
    now, most, lock = [0], [0], threading.Lock()

    def call(p):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.002)
        with lock:
            now[0] -= 1
        return p

    assert [r for _, r in critics.run_calls(list(map(str, range(60))), call, Limiter(1, 3, 1))] == list(map(str, range(60)))
    assert most[0] <= 3
    for total in range(1, 12):
        for tasks in range(1, total + 1):
            parts = [critics.share_of(total, tasks, k) for k in range(tasks)]
            assert sum(parts) == total and min(parts) >= 1


def test_each_hunk_is_sent_once(spark, tmp_path):
    """However many actions read findings and statuses."""
    log = str(tmp_path / "calls")

    class Counting:
        model_version = "m"

        def review(self, prompt):
            with open(log, "a") as f:
                f.write("call\n")
            return ["a remark", "another"]

    diff = spark.createDataFrame([("d", "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1,2 @@\n a\n+b\n@@ -9 +10,2 @@\n c\n+d\n")], "doc string, diff string")
    found, calls = pipelines.review(diff, "o/n", 1, "s", "t", Counting)
    assert found.count() == 4 and calls.count() == 2 and found.count() == 4
    assert {r.status for r in calls.collect()} == {"ok"}
    with open(log) as f:
        assert len(f.readlines()) == 2


def test_http_critic():
    seen = []

    def transport(url, body):
        seen.append((url, json.loads(body)))
        return 200, '{"choices":[{"message":{"content":" Fix it. "}}]}'

    critic = critics.HttpCritic("http://h/v1/", "m", transport)
    assert critic.review("P") == ["Fix it."]
    url, body = seen[0]
    assert url == "http://h/v1/chat/completions"
    assert [m["role"] for m in body["messages"]] == ["system", "user"] and body["stream"] is False
    assert critics.parse_completion('{"choices":[]}') == [] and critics.parse_completion('{"choices":[{"message":{"content":" "}}]}') == []
    with pytest.raises(critics.CallError):
        critics.parse_completion('{"choices":[{"message":{"content":null}}]}')
    with pytest.raises(critics.CallError) as e:
        critics.HttpCritic("h", "m", lambda u, b: (503, "x" * 500)).ask("p")
    assert e.value.overload and len(str(e.value)) < 260


def test_judge_all(spark):
    rows = [("f1", "p", "@@ -1 +1 @@\n+x", "c", None), ("f2", "p", "@@ -1 +1 @@\n+x", "c", {"verdict": "accept"})]
    schema = "finding_id string, path string, hunk_raw string, critic_comment string, machine struct<verdict: string, reason: string, judged_at: string, judged_by: string>"
    df = spark.createDataFrame([(*r[:4], (r[4]["verdict"], None, None, None) if r[4] else None) for r in rows], schema)

    def make():
        return critics.judge_endpoint("http://h", "j", lambda u, b: (200, '{"choices":[{"message":{"content":"REJECT\\nno"}}]}'))

    got = {r.finding_id: r.machine.verdict for r in critics.judge_all(df, make, "t").collect()}
    assert got == {"f1": "reject", "f2": "accept"}


SHAPE = hybrid.Shape()
MODEL = hybrid.Model.random(SHAPE, 1)


def test_cache_equals_full_pass():
    ids = np.array([[3, 9, 27, 17, 51, 25, 11]])
    full, _ = MODEL.advance(ids)
    first, state = MODEL.advance(ids[:, :2])
    parts = [first]
    for t in range(2, ids.shape[1]):
        out, state = MODEL.advance(ids[:, t : t + 1], state)
        parts.append(out)
    assert np.abs(np.concatenate(parts, 1) - full).max() < 1e-9
    assert MODEL.generate([5, 6, 7], 10) == MODEL.generate([5, 6, 7], 10, cached=False)
    assert MODEL.generate([5], 4) == MODEL.generate([5], 4, cached=False)  # shorter than the convolution


def test_batch_equals_single():
    prompts = [[1, 2, 3, 4, 5], [9, 8], [30]]
    assert MODEL.generate_batch(prompts, 8, (4,)) == [MODEL.generate(p, 8, (4,)) for p in prompts]


def test_generation_in_spark(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [4])], "k bigint, p array<int>")
    got = {r.k: r.ids for r in hybrid.generate_column(df, "k", "p", MODEL, 5).collect()}
    assert got == {1: MODEL.generate([1, 2, 3], 5), 2: MODEL.generate([4], 5)}


def test_delta_rule_column_equals_numpy(spark):
    rng = np.random.default_rng(0)
    q, k, v = (rng.normal(size=(1, 6, 1, 4)) for _ in range(3))
    g, beta = -np.abs(rng.normal(size=(1, 6, 1))), rng.random((1, 6, 1))
    out, _ = hybrid.delta_rule(q, k, v, g, beta)
    steps = [(q[0, t, 0].tolist(), k[0, t, 0].tolist(), v[0, t, 0].tolist(), float(g[0, t, 0]), float(beta[0, t, 0])) for t in range(6)]
    df = spark.createDataFrame([(steps,)], "s array<struct<q: array<double>, k: array<double>, v: array<double>, g: double, beta: double>>")
    unit = F.transform("s", lambda t: F.struct(V.l2norm(t["q"]).alias("q"), V.l2norm(t["k"]).alias("k"), t["v"].alias("v"), t["g"].alias("g"), t["beta"].alias("beta")))
    got = np.array(df.select(V.delta_rule(unit, 4, 4).alias("o")).first().o)
    assert np.abs(got - out[0, :, 0]).max() < 1e-12


def test_lora_merge_and_tensor_files(spark, tmp_path):
    name = "layers.3.q"
    a, b = np.ones((2, SHAPE.hidden)), np.ones((MODEL.w[name].shape[0], 2))
    assert np.allclose(MODEL.merged({name: (a, b)}, 64, 32).w[name] - MODEL.w[name], 4.0)
    data = {"x.one": np.arange(6.0).reshape(2, 3), "y.two": np.array([1.5])}
    (tmp_path / "t.safetensors").write_bytes(models.write_tensors(data))
    (tmp_path / "other.bin").write_bytes(b"no")
    rows = models.scan_tensors(spark, str(tmp_path), "x.").collect()
    assert [(r.name, r.shape, r.tensor) for r in rows] == [("x.one", [2, 3], [0, 1, 2, 3, 4, 5])]
    assert [(r.name, r.bytes) for r in models.list_tensors(spark, str(tmp_path)).orderBy("name").collect()] == [("x.one", 24), ("y.two", 4)]
    models.save_adapter(str(tmp_path / "lora"), {"model.layers.0.self_attn.q_proj.weight": (a, b)}, "base", 64.0)
    made = json.loads((tmp_path / "lora" / "adapter_config.json").read_text())
    assert (made["r"], made["lora_alpha"], made["target_modules"], made["peft_type"]) == (2, 64.0, ["q_proj"], "LORA")
    names = [r.name for r in models.scan_tensors(spark, str(tmp_path / "lora")).collect()]
    assert sorted(names) == [f"base_model.model.model.layers.0.self_attn.q_proj.lora_{m}.weight" for m in "AB"]


def test_learning_rate(spark):
    from hunkmill.operators import examples

    df = spark.range(11).select(examples.learning_rate_share(F.col("id"), F.lit(10), F.lit(2)).alias("x"))
    got = [r.x for r in df.collect()]
    assert got[:3] == [0.0, 0.5, 1.0] and got[6] == pytest.approx(0.5) and got[10] == pytest.approx(0.0) and got[3:] == sorted(got[3:], reverse=True)


def test_compare(spark):
    a = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0])], "k int, v array<double>")
    b = spark.createDataFrame([(1, [1.0, 2.5]), (3, [0.0])], "k int, v array<double>")
    row = evaluation.compare(a, b, ["k"], "v", 1.0).first()
    assert (row.n, row.missing, row.max_abs, row.within) == (1, 2, 0.5, False)
    evaluation.assert_same(a, a, ["k"], "v", 0.0)
    with pytest.raises(AssertionError):
        evaluation.assert_same(a, b, ["k"], "v", 1.0)


def test_masks(spark):
    row = spark.range(1).select(V.causal_mask(F.lit(2)).alias("c"), V.pad_mask(F.lit(2), F.lit(2)).alias("p")).first()
    assert row.c == [[0.0, -math.inf], [0.0, 0.0]]
    assert row.p == [[0.0, -math.inf], [-math.inf, 0.0]]


def test_tokenizer(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None)], "k int, s string")
    got = {r.k: r.x for r in df.select("k", models.tokenizer_columns(F.col("s"), "/opt/tokenizers/byte_bpe_50k.json").alias("x")).collect()}
    assert len(got[1]) == 2 and got[2] == [] and got[3] is None
