"""Named transformations, chains of them, and their inverses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Step] = {}


def register(name: str) -> Callable[[Step], Step]:
    def add(f: Step) -> Step:
        if name in REGISTRY:
            raise ValueError(f"{name!r} is registered")
        REGISTRY[name] = f
        return f

    return add


@dataclass(frozen=True)
class Invertible:
    apply: Step
    unapply: Step


@dataclass(frozen=True)
class Chain:
    """Steps in order; unapply() runs the inverses in reverse."""

    steps: list[Invertible] = field(default_factory=list)

    def apply(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = df.transform(s.apply)
        return df

    def unapply(self, df: DataFrame) -> DataFrame:
        for s in reversed(self.steps):
            df = df.transform(s.unapply)
        return df


def run_named(df: DataFrame, names: list[str]) -> DataFrame:
    for name in names:
        df = df.transform(REGISTRY[name])
    return df


def first_unsafe(checks: dict[str, Column]) -> Column:
    """The name of the first check that a row fails, in order; null if it passes all."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def skip_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Drop rows whose flag is 1; a flag that is missing or no number does not count."""
    return df.where(F.coalesce(F.expr(f"try_cast({flag} AS int)"), F.lit(0)) != 1)


def flatten(df: DataFrame, struct: str, fields: list[str]) -> DataFrame:
    """Some fields of a struct as columns; rows without one of them are dropped."""
    return df.select("*", *[F.col(f"{struct}.{f}").alias(f) for f in fields]).drop(struct).dropna(subset=fields)


class Registry(dict):
    """Things by name; a name is taken once."""

    def register(self, name: str):
        def add(thing):
            if name in self:
                raise ValueError(f"{name!r} is registered")
            self[name] = thing
            return thing

        return add

    def find(self, name: str):
        if name not in self:
            raise ValueError(f"{name!r} is none of {', '.join(sorted(self))}")
        return self[name]


#: (spark, path) to a DataFrame, bytes to a value, and (spark, path, ...) to a DataFrame of a file format, by name.
DATASETS, DECODERS, HANDLERS = Registry(), Registry(), Registry()


def expand(rows: DataFrame, times: str, name: str = "copy") -> DataFrame:
    """Each row as often as its column says, with copy from 0; a row with 0, less or null is skipped. A table function row by row."""
    return rows.where(F.col(times) > 0).select("*", F.explode(F.sequence(F.lit(0), F.col(times).cast("int") - 1)).alias(name))


def iterable_step(rows: DataFrame, f, schema: str) -> DataFrame:
    """Rows through a generator function from an iterator of pandas frames to one: it may skip, change or repeat rows."""
    return rows.mapInPandas(f, schema)


#: Presets: names of registered steps, in order.
PRESETS: dict[str, list[str]] = {}


def preset(df: DataFrame, name: str) -> DataFrame:
    return run_named(df, PRESETS[name])
