"""Vector functions on arrays of numbers, as column expressions in double precision.

A null array gives null.  Ties of an argmax go to the lowest index.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def wide(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; inside a lambda it would be computed for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def linear(x: Column, rows: Column) -> Column:
    """x times the transpose of a matrix given as an array of rows."""
    return F.transform(rows, lambda row: dot(x, row))


def scaled(v: Column, by: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double") * by)


def l2norm(v: Column, eps: float = 1e-6) -> Column:
    return let(1.0 / F.sqrt(dot(v, v) + eps), lambda n: scaled(v, n))


def rmsnorm(v: Column, weight: Column, eps: float = 1e-6, one_plus: bool = True) -> Column:
    """Root-mean-square norm, times one plus the weight or the weight itself."""
    norm = 1.0 / F.sqrt(dot(v, v) / F.size(v) + eps)
    return let(norm, lambda n: F.zip_with(v, weight, lambda x, w: x.cast("double") * n * (w + 1.0 if one_plus else w)))


def sigmoid(v: Column) -> Column:
    return F.transform(v, lambda x: 1.0 / (1.0 + F.exp(-x.cast("double"))))


def silu(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double") / (1.0 + F.exp(-x.cast("double"))))


def softplus(v: Column) -> Column:
    """ln(1 + e^x) without overflow."""
    return F.transform(v, lambda x: F.greatest(x.cast("double"), F.lit(0.0)) + F.log1p(F.exp(-F.abs(x.cast("double")))))


def gated_rmsnorm(v: Column, gate: Column, weight: Column, eps: float = 1e-6) -> Column:
    return F.zip_with(rmsnorm(v, weight, eps, one_plus=False), silu(gate), lambda x, g: x * g)


def softmax(v: Column) -> Column:
    raised = let(F.array_max(v).cast("double"), lambda top: F.transform(v, lambda x: F.exp(x.cast("double") - top)))
    return let(raised, lambda r: let(1.0 / total(r), lambda n: scaled(r, n)))


def log_softmax(v: Column) -> Column:
    def below(top: Column) -> Column:
        rest = F.log(total(F.transform(v, lambda x: F.exp(x.cast("double") - top))))
        return let(rest, lambda r: F.transform(v, lambda x: x.cast("double") - top - r))

    return let(F.array_max(v).cast("double"), below)


def argmax(v: Column) -> Column:
    """Index from 0; null for an empty array."""
    return F.nullif(F.array_position(v, F.array_max(v)), F.lit(0).cast("bigint")) - 1


def top_k(v: Column, k: int) -> Column:
    """Array of struct(value, index) of the k largest, the lowest index first among equals."""
    pairs = F.transform(v, lambda x, i: F.struct((-x).alias("neg"), i.alias("index")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda p: F.struct((-p["neg"]).alias("value"), p["index"].alias("index")))


def causal_mask(n: Column) -> Column:
    """n rows of 0 up to the diagonal and minus infinity beyond."""
    return F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.when(j <= i, 0.0).otherwise(float("-inf")))
    )


def pad_mask(n: Column, pads: Column) -> Column:
    """As :func:`causal_mask`, with padded columns closed; the diagonal stays open, so no row is all closed."""
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.when((j <= i) & ((j >= pads) | (i == j)), 0.0).otherwise(float("-inf"))),
    )


def rope_angles(position: Column, dims: int, theta: float = 10_000.0) -> Column:
    """position * theta^(-2i/dims) for each of the dims/2 pairs."""
    return F.array(*[position * F.lit(theta ** (-2.0 * i / dims)) for i in range(dims // 2)])


def rotate_half(v: Column) -> Column:
    half = (F.size(v) / 2).cast("int")
    return F.concat(F.transform(F.slice(v, half + 1, half), lambda x: -x), F.slice(v, F.lit(1), half))


def apply_rope(v: Column, position: Column, dims: int, theta: float = 10_000.0) -> Column:
    """The first ``dims`` numbers rotated by the position, the rest as they are."""
    head, rest = wide(F.slice(v, 1, dims)), wide(F.slice(v, F.lit(dims + 1), F.greatest(F.size(v) - dims, F.lit(0))))
    angles = rope_angles(position, dims, theta)
    both = F.concat(angles, angles)
    turned = F.zip_with(rotate_half(head), both, lambda x, a: x * F.sin(a))
    kept = F.zip_with(head, both, lambda x, a: x * F.cos(a))
    return F.concat(F.zip_with(kept, turned, lambda x, y: x + y), rest)


def repeat_each(v: Column, times: int) -> Column:
    """Each element ``times`` times, next to each other."""
    return F.flatten(F.transform(v, lambda x: F.array_repeat(x, times)))


def gather(v: Column, places: Column) -> Column:
    """Elements at places counted from 0."""
    return F.transform(places, lambda i: F.element_at(v, i + 1))


def delta_rule(steps: Column, dk: int, dv: int) -> Column:
    """Outputs of the gated delta rule of one head, folded over an ordered array of
    struct(q, k, v arrays, g, beta doubles); the state is dk rows of dv numbers.

    Decay the state, read it with the key, write the scaled difference back, read it with the query.
    """
    state0 = F.array_repeat(F.array_repeat(F.lit(0.0), dv), dk)
    zero = F.struct(state0.alias("s"), F.array().cast("array<array<double>>").alias("out"))

    def read(s: Column, by: Column) -> Column:
        weighted = F.zip_with(s, by, lambda row, x: F.transform(row, lambda y: y * x))
        return F.aggregate(weighted, F.array_repeat(F.lit(0.0), dv), lambda a, row: F.zip_with(a, row, lambda x, y: x + y))

    def step(a: Column, t: Column) -> Column:
        s = F.transform(a["s"], lambda row: F.transform(row, lambda x: x * F.exp(t["g"])))
        delta = F.zip_with(t["v"], read(s, t["k"]), lambda v, m: (v - m) * t["beta"])
        new = F.zip_with(s, t["k"], lambda row, k: F.zip_with(row, delta, lambda x, d: x + k * d))
        out = read(new, F.transform(t["q"], lambda x: x / F.sqrt(F.lit(float(dk)))))
        return F.struct(new.alias("s"), F.array_append(a["out"], out).alias("out"))

    return F.aggregate(steps, zero, step, lambda a: a["out"])
