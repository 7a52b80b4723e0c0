"""Which frames of a video a sample takes; index arithmetic alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def history(t: Column, n: int, spacing: int) -> Column:
    """max(t - k * spacing, 0) for k = n, ..., 1."""
    return F.transform(F.sequence(F.lit(n), F.lit(1), F.lit(-1)), lambda k: F.greatest(t - k * spacing, F.lit(0)))


def strides(n: Column, fps: Column, length: int, low: float, high: float) -> Column:
    """Strides of which `length` frames fit into n, with fps / stride in [low, high]."""
    if length < 2 or low <= 0:
        raise ValueError("two frames and a positive fps at least")
    most = F.least(F.floor((n - 1) / (length - 1)), F.floor(fps / low)).cast("int")
    every = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda s: ((length - 1) * s < n) & (fps / s >= low) & (fps / s <= high))


def controlled_fps(fps: Column, n: Column, length: int, low: int, high: int, power: float, u: Column) -> Column:
    """The whole fps at which `length` frames are taken of n at `fps`, drawn by a uniform number u; fps f has the weight 1 / f ** power.

    It is between low and high, no more than fps, and enough for the frames to fit; where nothing is left to draw, the highest.
    """
    least = F.greatest(F.lit(low), F.ceil(fps * float(length) / n.cast("double")).cast("int"))
    most = F.least(F.lit(high), fps)
    choices = F.sequence(least, F.greatest(most, least))
    weight = lambda f: 1.0 / F.pow(f.cast("double"), F.lit(float(power)))
    total = F.aggregate(choices, F.lit(0.0), lambda a, f: a + weight(f))
    none = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("f"))
    step = lambda a, f: F.struct((a["sum"] + weight(f)).alias("sum"), F.coalesce(a["f"], F.when(a["sum"] + weight(f) > u * total, f)).alias("f"))
    return F.when(most > least, F.coalesce(F.aggregate(choices, none, step)["f"], most)).otherwise(most)


def chunk_count(n: Column, chunk: int, length: int) -> Column:
    """Chunks of n frames; the rest is one of its own if it has half a chunk and over `length` frames."""
    rest = F.pmod(n, F.lit(chunk))
    whole = F.floor(n / chunk)
    return F.when(whole == 0, 1).otherwise(whole + F.when((rest >= chunk / 2) & (rest > length), 1).otherwise(0)).cast("int")


def centered(start: Column, end: Column, length: int) -> Column:
    """`length` frames of [start, end) at the largest stride that fits, in the middle."""
    m = F.floor((end - start) / length).cast("int")
    first = start + F.floor((end - start - length * m) / 2).cast("int")
    return F.when(m > 0, F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: first + i * m))


def interleaved(n: Column) -> Column:
    """Every fourth and every fifth frame, in order, without the first and the last."""
    both = F.array_sort(F.concat(F.sequence(F.lit(0), n - 1, F.lit(4)), F.sequence(F.lit(0), n - 1, F.lit(5))))
    return F.slice(both, 2, F.greatest(F.size(both) - 2, F.lit(0)))


def sequences(n: Column, length: int, interval: int, stride: int) -> Column:
    """Starts of the complete sequences of `length` frames at a stride, one every `interval` frames."""
    last = n - 1 - (length - 1) * stride
    return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(interval))).otherwise(F.array().cast("array<int>"))


def resize(w: Column, h: Column, to_w: int, to_h: int) -> list[Column]:
    """Sides that cover a target at the same aspect."""
    scale = F.greatest(to_w / w, to_h / h)
    return [F.floor(scale * w + 0.5).cast("int"), F.floor(scale * h + 0.5).cast("int")]


def time_grid(start: Column, end: Column, fps: float) -> Column:
    """start + i / fps for floor((end - start) * fps) points."""
    n = F.floor((end - start) * fps).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + i / fps)).otherwise(F.array().cast("array<double>"))


def time_range(start: Column, end: Column, fps: float) -> Column:
    """start + i / fps below end."""
    n = F.ceil((end - start) * fps).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + i / fps)).otherwise(F.array().cast("array<double>"))


def learning_rate(n: Column, warm_up: list[int], cycles: list[int], f_start: float, f_max: float, f_min: float, shape: str) -> Column:
    """Factor at step n of cycles, each of linear warm-up and cosine or linear decay."""
    out, begin = None, 0
    for steps, warm in zip(cycles, warm_up, strict=True):
        k = n - begin
        t = F.least((k - warm) / max(1, steps - warm), F.lit(1.0))
        fall = 0.5 * (1 + F.cos(t * 3.141592653589793)) if shape == "cosine" else 1 - t
        f = F.when(k < warm, f_start + (f_max - f_start) * k / max(1, warm)).otherwise(f_min + (f_max - f_min) * fall)
        begin += steps
        out = F.when(n <= begin, f) if out is None else out.when(n <= begin, f)
    return out
