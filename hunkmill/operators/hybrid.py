"""A small hybrid language model in numpy, for Arrow batch functions: gated attention and delta-rule layers.

One code path serves a whole sequence, a prompt that fills a cache, and single further tokens: every layer
takes a chunk of positions and the state before it, and returns the state behind it.  Left padding is a mask.
All in double precision; meant for toy sizes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill.registry import query
from hunkmill.workspace import load

Array = np.ndarray


@dataclass(frozen=True)
class Shape:
    """Sizes of the model."""

    hidden: int = 16
    layers: int = 4
    interval: int = 4
    heads: int = 4
    kv_heads: int = 2
    head_dim: int = 8
    rotary: int = 4
    theta: float = 10_000.0
    value_heads: int = 4
    key_heads: int = 2
    key_dim: int = 4
    value_dim: int = 4
    kernel: int = 4
    inner: int = 24
    vocab: int = 64
    eps: float = 1e-6

    def full(self, layer: int) -> bool:
        """Whether the layer attends in full; the others run the delta rule."""
        return (layer + 1) % self.interval == 0

    @property
    def conv_dim(self) -> int:
        return 2 * self.key_heads * self.key_dim + self.value_heads * self.value_dim


def sigmoid(x: Array) -> Array:
    return 1.0 / (1.0 + np.exp(-x))


def silu(x: Array) -> Array:
    return x * sigmoid(x)


def softplus(x: Array) -> Array:
    return np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))


def norm(x: Array, scale: Array | float, eps: float) -> Array:
    return x / np.sqrt((x * x).mean(-1, keepdims=True) + eps) * scale


def unit(x: Array, eps: float = 1e-6) -> Array:
    return x / np.sqrt((x * x).sum(-1, keepdims=True) + eps)


def rotate(x: Array, positions: Array, shape: Shape) -> Array:
    """Rotary positions on the first numbers of each head; x is (batch, time, heads, size), positions (batch, time)."""
    n = shape.rotary
    angle = positions[..., None] * shape.theta ** (-2.0 * np.arange(n // 2) / n)
    cos, sin = (np.concatenate([f(angle)] * 2, -1)[:, :, None] for f in (np.cos, np.sin))
    head, rest = x[..., :n], x[..., n:]
    half = np.concatenate([-head[..., n // 2 :], head[..., : n // 2]], -1)
    return np.concatenate([head * cos + half * sin, rest], -1)


def delta_rule(q: Array, k: Array, v: Array, g: Array, beta: Array, state: Array | None = None) -> tuple[Array, Array]:
    """(out, state) over (batch, time, heads, size); q and k are made unit vectors."""
    q, k = unit(q) / np.sqrt(q.shape[-1]), unit(k)
    s = np.zeros((*q.shape[:1], q.shape[2], q.shape[3], v.shape[3])) if state is None else state
    out = np.empty(v.shape)
    for t in range(q.shape[1]):
        s = s * np.exp(g[:, t])[..., None, None]
        known = np.einsum("bhkv,bhk->bhv", s, k[:, t])
        s = s + np.einsum("bhk,bhv->bhkv", k[:, t], (v[:, t] - known) * beta[:, t][..., None])
        out[:, t] = np.einsum("bhkv,bhk->bhv", s, q[:, t])
    return out, s


@dataclass
class State:
    """What each layer needs from the positions before; ``real`` marks those that are no padding."""

    layers: list = field(default_factory=list)
    real: Array | None = None


class Model:
    """Weights by name and the passes over them."""

    def __init__(self, shape: Shape, weights: dict[str, Array]):
        self.shape, self.w = shape, weights

    @classmethod
    def random(cls, shape: Shape, seed: int = 0) -> Model:
        rng = np.random.default_rng(seed)
        h, w = shape.hidden, {}

        def put(name: str, *dims: int, scale: float = 0.3) -> None:
            w[name] = rng.normal(0, scale, dims)

        put("embed", shape.vocab, h, scale=1.0)
        put("lm_head", shape.vocab, h)
        put("norm", h, scale=0.1)
        for i in range(shape.layers):
            p = f"layers.{i}."
            put(p + "in_norm", h, scale=0.1)
            put(p + "post_norm", h, scale=0.1)
            put(p + "gate", shape.inner, h)
            put(p + "up", shape.inner, h)
            put(p + "down", h, shape.inner)
            if shape.full(i):
                put(p + "q", 2 * shape.heads * shape.head_dim, h)
                put(p + "k", shape.kv_heads * shape.head_dim, h)
                put(p + "v", shape.kv_heads * shape.head_dim, h)
                put(p + "o", h, shape.heads * shape.head_dim)
                put(p + "q_norm", shape.head_dim, scale=0.1)
                put(p + "k_norm", shape.head_dim, scale=0.1)
            else:
                value = shape.value_heads * shape.value_dim
                put(p + "qkv", shape.conv_dim, h)
                put(p + "z", value, h)
                put(p + "b", shape.value_heads, h)
                put(p + "a", shape.value_heads, h)
                put(p + "conv", shape.conv_dim, shape.kernel)
                put(p + "dt_bias", shape.value_heads)
                put(p + "a_log", shape.value_heads)
                w[p + "out_norm"] = 1 + rng.normal(0, 0.1, shape.value_dim)
                put(p + "out", h, value)
        return cls(shape, w)

    def merged(self, adapters: dict[str, tuple[Array, Array]], alpha: float, rank: int) -> Model:
        """With ``alpha / rank * B A`` added to each weight that has a pair (A, B)."""
        added = {n: self.w[n] + alpha / rank * (b @ a) for n, (a, b) in adapters.items() if n in self.w}
        return Model(self.shape, self.w | added)

    def attend(self, p: str, x: Array, positions: Array, real: Array, past: tuple[Array, Array] | None) -> tuple[Array, tuple[Array, Array]]:
        """Gated grouped-query attention of a chunk over all positions so far."""
        c, w = self.shape, self.w
        b, t, _ = x.shape
        qg = (x @ w[p + "q"].T).reshape(b, t, c.heads, 2 * c.head_dim)
        q, gate = qg[..., : c.head_dim], qg[..., c.head_dim :].reshape(b, t, -1)
        k = (x @ w[p + "k"].T).reshape(b, t, c.kv_heads, c.head_dim)
        v = (x @ w[p + "v"].T).reshape(b, t, c.kv_heads, c.head_dim)
        q = rotate(norm(q, 1 + w[p + "q_norm"], c.eps), positions, c)
        k = rotate(norm(k, 1 + w[p + "k_norm"], c.eps), positions, c)
        if past is not None:
            k, v = np.concatenate([past[0], k], 1), np.concatenate([past[1], v], 1)
        wide_k, wide_v = (np.repeat(y, c.heads // c.kv_heads, axis=2) for y in (k, v))
        score = np.einsum("bqhd,bkhd->bhqk", q, wide_k) / np.sqrt(c.head_dim)
        at, total = np.arange(k.shape[1] - t, k.shape[1]), np.arange(k.shape[1])
        # a position sees itself whatever its padding, so no row is closed
        seen = (total <= at[:, None]) & (real[:, None, :] | (total == at[:, None]))
        score = np.where(seen[:, None], score, -np.inf)
        weight = np.exp(score - score.max(-1, keepdims=True))
        weight /= weight.sum(-1, keepdims=True)
        out = np.einsum("bhqk,bkhd->bqhd", weight, wide_v).reshape(b, t, -1)
        return (out * sigmoid(gate)) @ w[p + "o"].T, (k, v)

    def mix(self, p: str, x: Array, real_now: Array, past: tuple[Array, Array] | None) -> tuple[Array, tuple[Array, Array]]:
        """Causal convolution and delta rule of a chunk; the state is the last inputs of the convolution and the memory.

        Short prompts are fine: the convolution's history starts as zeros.
        """
        c, w = self.shape, self.w
        b, t, _ = x.shape
        x = x * real_now[..., None]
        mixed = x @ w[p + "qkv"].T
        tail, memory = past if past is not None else (np.zeros((b, c.kernel - 1, c.conv_dim)), None)
        window = np.concatenate([tail, mixed], 1)
        conv = sum(window[:, j : j + t] * w[p + "conv"][:, j] for j in range(c.kernel))
        qkv, key = silu(conv), c.key_heads * c.key_dim
        q, k = (np.repeat(y.reshape(b, t, c.key_heads, c.key_dim), c.value_heads // c.key_heads, axis=2) for y in (qkv[..., :key], qkv[..., key : 2 * key]))
        v = qkv[..., 2 * key :].reshape(b, t, c.value_heads, c.value_dim)
        g = -np.exp(w[p + "a_log"]) * softplus(x @ w[p + "a"].T + w[p + "dt_bias"])
        out, memory = delta_rule(q, k, v, g, sigmoid(x @ w[p + "b"].T), memory)
        gate = silu((x @ w[p + "z"].T).reshape(out.shape))
        out = (norm(out, w[p + "out_norm"], c.eps) * gate).reshape(b, t, -1)
        return out @ w[p + "out"].T, (window[:, -(c.kernel - 1) :], memory)

    def advance(self, ids: Array, state: State | None = None, real: Array | None = None) -> tuple[Array, State]:
        """(logits, state) of a chunk of ids (batch, time); ``real`` is False at padding."""
        c, w = self.shape, self.w
        state = state or State()
        now = np.ones(ids.shape, bool) if real is None else real.astype(bool)
        seen = now if state.real is None else np.concatenate([state.real, now], 1)
        positions = np.maximum(np.cumsum(seen, 1) - 1, 0)[:, -ids.shape[1] :]
        x, after = w["embed"][ids], []
        for i in range(c.layers):
            p, past = f"layers.{i}.", state.layers[i] if state.layers else None
            h = norm(x, 1 + w[p + "in_norm"], c.eps)
            h, kept = self.attend(p, h, positions, seen, past) if c.full(i) else self.mix(p, h, now, past)
            x, _ = x + h, after.append(kept)
            h = norm(x, 1 + w[p + "post_norm"], c.eps)
            x = x + (silu(h @ w[p + "gate"].T) * (h @ w[p + "up"].T)) @ w[p + "down"].T
        return norm(x, 1 + w["norm"], c.eps) @ w["lm_head"].T, State(after, seen)

    def generate(self, prompt: list[int], most: int, stops: tuple[int, ...] = (), cached: bool = True) -> list[int]:
        """Prompt and greedy continuation, up to the first stop, which is kept."""
        ids, state, chunk = list(prompt), None, list(prompt)
        for _ in range(most):
            logits, kept = self.advance(np.array([chunk]), state)
            ids.append(int(logits[0, -1].argmax()))
            if ids[-1] in stops:
                break
            state, chunk = (kept, ids[-1:]) if cached else (None, ids)
        return ids

    def generate_batch(self, prompts: list[list[int]], most: int, stops: tuple[int, ...] = ()) -> list[list[int]]:
        """As :meth:`generate` for prompts of different lengths, padded on the left."""
        width = max(map(len, prompts))
        ids = np.array([[0] * (width - len(p)) + p for p in prompts])
        real = np.array([[False] * (width - len(p)) + [True] * len(p) for p in prompts])
        out, open_ = [list(p) for p in prompts], [True] * len(prompts)
        state, mask = None, real
        for _ in range(most):
            logits, state = self.advance(ids, state, mask)
            best = logits[:, -1].argmax(-1)
            for r, token in enumerate(best.tolist()):
                if open_[r]:
                    out[r].append(token)
                    open_[r] = token not in stops
            if not any(open_):
                break
            ids, mask = best[:, None], np.ones((len(prompts), 1), bool)
        return out


def generate_column(rows: DataFrame, key: str, ids: str, model: Model, most: int, stops: tuple[int, ...] = ()) -> DataFrame:
    """(key, ids): greedy continuations; each batch of rows is one padded batch of the model."""
    kind = rows.schema[key].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast((model.shape, model.w))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Model(*shared.value)
        for frame in frames:
            if len(frame):
                prompts = [list(map(int, x)) for x in frame["ids"]]
                yield pd.DataFrame({key: frame[key], "ids": made.generate_batch(prompts, most, stops)})

    return rows.select(key, F.col(ids).alias("ids")).mapInPandas(run, f"`{key}` {kind}, ids array<int>")


@query()
def greedy_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight tokens behind prompts made of the vectors' signs, by a model with fixed random weights."""
    v = F.col("embedding")
    token = F.transform(F.slice(v, 1, 6), lambda x, i: F.pmod(F.floor(F.abs(x) * 1000) + i, F.lit(64)).cast("int"))
    prompts = load(spark, sf_dir, "embeddings").select("vec_id", F.slice(token, F.lit(1), (F.pmod("vec_id", F.lit(4)) + 3).cast("int")).alias("prompt"))
    return generate_column(prompts, "vec_id", "prompt", Model.random(Shape(), seed=3), 8, (5,))
