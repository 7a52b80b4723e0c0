"""Declarative checks: one query that lists what is wrong."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, check) for each row and check that does not hold; null does not hold. One pass over the rows."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    return rows.select(key, F.explode(failed).alias("check"))


def missing_keys(rows: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Keys of rows that the reference lacks."""
    return rows.select(key).distinct().join(reference.select(key), key, "left_anti")


def all_violations(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def frame_request(n: Column, fps: Column, low: Column, high: Column, length: Column) -> Column:
    """Why a request for frames is bad, or empty."""
    return (
        F.when(length <= 0, "no frames asked for")
        .when(low > high, "empty fps range")
        .when(fps <= 0, "no frame rate")
        .when(n < length, "too few frames")
        .otherwise("")
    )


def check_mode(mode: str, statistics: set[str], relative: bool = False, discrete: bool = False) -> None:
    """Raise ValueError unless a normalization mode fits its statistics and its kind of value."""
    needed = {"q99": {"q01", "q99"}, "mean_std": {"mean", "std"}, "min_max": {"min", "max"}, "scale": {"min", "max"}, "binary": set()}
    if mode not in needed:
        raise ValueError(f"no normalization {mode!r}")
    if missing := needed[mode] - statistics:
        raise ValueError(f"{mode} needs {', '.join(sorted(missing))}")
    if relative:
        raise ValueError("relative rotations are not normalized")
    if discrete and mode != "binary":
        raise ValueError("discrete values need binary")


def in_range(index: Column, size: Column) -> Column:
    """Whether an index is one of a list of a size; null is not."""
    return F.coalesce((index >= 0) & (index < size), F.lit(False))


def pixel_faults(v: Column) -> Column:
    """nan or infinite where an array has such a value, else empty."""
    return F.when(F.exists(v, F.isnan), "nan").when(F.exists(v, lambda x: F.abs(x) == math.inf), "infinite").otherwise("")


def checked_bool(value: object) -> bool:
    if isinstance(value, str) and value.lower() in ("true", "1", "false", "0"):
        return value.lower() in ("true", "1")
    if value in (0, 1):  # True and False too
        return bool(value)
    raise ValueError(f"{value!r} is no boolean")


def checked_number(kind: type, low: float | None = None, high: float | None = None, multiple_of: int | None = None) -> Callable[[object], float]:
    """A check that gives a value as int or float, within bounds, and a multiple of a number."""

    def check(value: object) -> float:
        try:
            out = kind(value)
        except (TypeError, ValueError) as e:
            raise ValueError(f"{value!r} is no {kind.__name__}") from e
        if (kind is int and out != float(value)) or (low is not None and out < low) or (high is not None and out > high):
            raise ValueError(f"{value!r} is no {kind.__name__} from {low} to {high}")
        if multiple_of and out % multiple_of:
            raise ValueError(f"{value!r} is no multiple of {multiple_of}")
        return out

    return check


def checked_string(low: int = 0, high: int | None = None, holds: Callable[[str], bool] | None = None) -> Callable[[object], str | None]:
    """A check that a value is None or a string of some length for which a predicate holds."""

    def check(value: object) -> str | None:
        if value is None:
            return None
        if not isinstance(value, str) or len(value) < low or (high is not None and len(value) > high) or (holds and not holds(value)):
            raise ValueError(f"{value!r} is no string of {low} to {high} characters that passes")
        return value

    return check


def one_of(*options: object, cast: type | None = None) -> Callable[[object], object]:
    def check(value: object) -> object:
        out = cast(value) if cast else value
        if out not in options:
            raise ValueError(f"{value!r} is none of {options!r}")
        return out

    return check


def checked_json(value: str | dict) -> dict:
    """A dict, or the dict of a JSON string."""
    out = json.loads(value) if isinstance(value, str) else value
    if not isinstance(out, dict):
        raise ValueError(f"{value!r} is no JSON object")
    return out


def check_config(config: dict, rules: dict[str, Callable[[object], object]]) -> dict:
    """The config with every value checked; all that is wrong is told at once."""
    out, wrong = {}, []
    for name, rule in rules.items():
        try:
            out[name] = rule(config[name])
        except (KeyError, ValueError) as e:
            wrong.append(f"{name}: {e}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return out
