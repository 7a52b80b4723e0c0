"""Functions of numeric array columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def rescale(x: Column, lo: Column, hi: Column, signed: bool = True, floor: float = 1e-8, multiplier: float = 1.0) -> Column:
    """Linear map of [lo, hi] to [-1, 1] or [0, 1]; a span below `floor` counts as 1."""
    span = F.when(hi - lo < floor, F.lit(1.0)).otherwise(hi - lo)
    unit = (x - lo) / span
    return multiplier * (2 * unit - 1 if signed else unit)


def rescale_vector(v: Column, lo: Column, hi: Column, signed: bool = True) -> Column:
    return F.transform(v, lambda x, i: rescale(x, F.get(lo, i), F.get(hi, i), signed))


def unscale(x: Column, lo: Column, hi: Column) -> Column:
    """From [-1, 1] back to [lo, hi]."""
    return 0.5 * (x + 1) * (hi - lo) + lo


def normalize(x: Column, mode: str, s: dict[str, Column]) -> Column:
    """One of q99, mean_std, min_max, scale or binary, with statistics min, max, mean, std, q01 and q99.

    Degenerate dimensions pass through under q99 (still clamped) and mean_std, and give 0 under min_max and scale.
    """
    if mode == "q99":
        moved = F.when(s["q99"] != s["q01"], 2 * (x - s["q01"]) / F.nullif(s["q99"] - s["q01"], F.lit(0.0)) - 1).otherwise(x)
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), moved))
    if mode == "mean_std":
        return F.when(s["std"] != 0, (x - s["mean"]) / F.nullif(s["std"], F.lit(0.0))).otherwise(x)
    if mode == "min_max":
        return F.when(s["max"] != s["min"], 2 * (x - s["min"]) / F.nullif(s["max"] - s["min"], F.lit(0.0)) - 1).otherwise(0.0)
    if mode == "scale":
        most = F.greatest(F.abs(s["min"]), F.abs(s["max"]))
        return F.when(most != 0, x / F.nullif(most, F.lit(0.0))).otherwise(0.0)
    if mode == "binary":
        return (x > 0.5).cast("double")
    raise ValueError(f"no normalization {mode!r}")


def denormalize(x: Column, mode: str, s: dict[str, Column]) -> Column:
    """Inverse of normalize(); scale has none."""
    if mode == "q99":
        return (x + 1) / 2 * (s["q99"] - s["q01"]) + s["q01"]
    if mode == "mean_std":
        return x * s["std"] + s["mean"]
    if mode == "min_max":
        return (x + 1) / 2 * (s["max"] - s["min"]) + s["min"]
    if mode == "binary":
        return (x > 0.5).cast("double")
    raise ValueError(f"normalization {mode!r} has no inverse")


def take(v: Column, start: int, end: int) -> Column:
    """Elements [start, end) from 0."""
    return F.slice(v, start + 1, end - start)


def embed(v: Column, before: int, after: int = 0) -> Column:
    """v inside a wider vector of zeros."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    return F.concat(zeros(before), v, zeros(after))


def pad_to(v: Column, size: int, filler: Column) -> Column:
    """The first `size` elements, with fillers if there are fewer."""
    return F.concat(F.slice(v, 1, size), F.array_repeat(filler, F.greatest(F.lit(0), F.lit(size) - F.size(v))))


def pad_mask(v: Column, size: int) -> Column:
    """1 for elements of v and 0 for fillers of pad_to()."""
    kept = F.least(F.size(v), F.lit(size))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(size) - kept))


def repeat_interleave(v: Column, n: int) -> Column:
    return F.flatten(F.transform(v, lambda x: F.array_repeat(x, n)))


def sincos(v: Column) -> Column:
    """All sines, then all cosines."""
    return F.concat(F.transform(v, F.sin), F.transform(v, F.cos))


def position_embedding(position: Column, size: int) -> Column:
    """Sinusoidal embedding: size / 2 sines and as many cosines, of frequencies 10000 ** (-2 i / size)."""
    rate = lambda i: F.lit(1.0) / F.pow(F.lit(10000.0), i / (size / 2.0))
    steps = F.sequence(F.lit(0), F.lit(size // 2 - 1))
    return F.concat(F.transform(steps, lambda i: F.sin(position * rate(i))), F.transform(steps, lambda i: F.cos(position * rate(i))))


def debin(index: Column, bins: int, lo: Column, hi: Column) -> Column:
    return index / (bins - 1) * (hi - lo) + lo


def to_uint8(x: Column) -> Column:
    """[0, 1] to 0..255, clipped, half to even."""
    return F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) * 255).cast("int")


def all_finite(v: Column) -> Column:
    return F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))


def is_mask(v: Column) -> Column:
    """Zeros and ones, with a one."""
    return (F.size(v) > 0) & F.forall(v, lambda x: x.isin(0.0, 1.0)) & F.exists(v, lambda x: x == 1.0)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def combine(a: Column, b: Column, op: str) -> Column:
    """Element by element: add, sub, mul or div."""
    f = {"add": lambda x, y: x + y, "sub": lambda x, y: x - y, "mul": lambda x, y: x * y, "div": lambda x, y: x / y}[op]
    return F.zip_with(a, b, f)


def availability_weights(mask: Column) -> Column:
    """A mask scaled so that it sums to its size."""
    active = F.aggregate(mask, F.lit(0.0), lambda a, x: a + x)
    return F.when(active == 0, F.raise_error(F.lit("no active element"))).otherwise(F.transform(mask, lambda x: x * F.size(mask) / active))


def fold_ema(v: Column, beta: float) -> Column:
    """beta * ema + (1 - beta) * x over the elements, from the first."""
    return F.aggregate(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), F.get(v, F.lit(0)), lambda a, x: beta * a + (1 - beta) * x)
