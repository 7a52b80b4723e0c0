"""Operators over steps: (episode, step, values), in windows of one episode."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("episode_id", "step_idx")


def episode(order: bool = True) -> WindowSpec:
    w = Window.partitionBy(KEYS[0])
    return w.orderBy(KEYS[1]) if order else w


def last_index() -> Column:
    return F.count("*").over(episode(False)) - 1


def action_chunk(steps: DataFrame, value: str, size: int, name: str) -> DataFrame:
    """The next `size` values from each step on; past the end the last one repeats."""
    ahead = episode().rowsBetween(0, size - 1)
    c = F.collect_list(value).over(ahead)
    return steps.withColumn(name, F.concat(c, F.array_repeat(F.element_at(c, -1), F.lit(size) - F.size(c))))


def at_offset(steps: DataFrame, value: str, offset: int, name: str) -> DataFrame:
    """The value `offset` steps ahead, or at the episode's last step."""
    whole = episode().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return steps.withColumn(name, F.coalesce(F.lead(value, offset).over(episode()), F.last(value).over(whole)))


def future_index(offset: int) -> Column:
    return F.least(F.col(KEYS[1]) + offset, last_index()).cast("int")


def returns(steps: DataFrame, reward: Column, gamma: float, name: str = "value") -> DataFrame:
    """Discounted final reward at each step, mapped to [-1, 1]; any positive reward gives the same curve."""
    x = F.pow(F.lit(gamma), last_index() - F.col(KEYS[1])) * reward
    return steps.withColumn(name, F.when(reward > 0, 2 * x / F.nullif(reward, F.lit(0.0)) - 1).otherwise(2 * x - 1))


def terminal_flag() -> Column:
    return (F.col(KEYS[1]) == last_index()).cast("int")


def forward_difference(value: str) -> Column:
    """a[i + 1] - a[i]; the last step repeats the one before; 0 in an episode of one step."""
    w = episode()
    ahead, back = F.lead(value).over(w) - F.col(value), F.col(value) - F.lag(value).over(w)
    return F.coalesce(ahead, back, F.lit(0.0))


def gradient(value: str, dt: float) -> Column:
    """Central differences inside, one-sided at the ends; null in an episode of one step."""
    w = episode()
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return F.when(before.isNotNull() & after.isNotNull(), (after - before) / 2).when(after.isNotNull(), after - F.col(value)).otherwise(F.col(value) - before) / dt


def chunk_baseline_delta(steps: DataFrame, value: str, size: int, name: str) -> DataFrame:
    """From step 1 on, chunks of `size` steps less the value just before the chunk."""
    first = (F.floor((F.col(KEYS[1]) - 1) / size) * size).cast("int")
    rows = steps.withColumn("_first", first).withColumn("_before", F.lag(value).over(episode())).where(F.col(KEYS[1]) > 0)
    chunk = Window.partitionBy(KEYS[0], "_first").orderBy(KEYS[1])
    return rows.withColumn(name, F.col(value) - F.first("_before").over(chunk)).drop("_before")


def drop_noops(steps: DataFrame, norm: Column, gripper: str, least: float = 1e-4) -> DataFrame:
    """Drop steps that neither move nor change the gripper against the last step that was kept.

    A dropped step has the gripper of the last kept one, so the step before serves; the first step that moves opens the rest.
    """
    w = episode()
    rows = steps.withColumn("_moves", (norm >= least).cast("int")).withColumn("_grip", F.lag(gripper).over(w))
    earlier = F.max("_moves").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_open", F.coalesce(earlier, F.lit(0)))
    keep = (F.col("_moves") == 1) | ((F.col("_open") == 1) & (F.col(gripper) != F.col("_grip")))
    return rows.where(keep).drop("_moves", "_grip", "_open")


def until_success(steps: DataFrame, success: Column) -> DataFrame:
    """Steps up to the first success, which stays."""
    before = F.max(success.cast("int")).over(episode().rowsBetween(Window.unboundedPreceding, -1))
    return steps.withColumn("_done", F.coalesce(before, F.lit(0))).where("_done = 0").drop("_done")


def long_enough(steps: DataFrame, least: int) -> DataFrame:
    return steps.withColumn("_n", F.count("*").over(episode(False))).where(F.col("_n") >= least).drop("_n")


def gather_ends(steps: DataFrame, value: str, deltas: list[int]) -> DataFrame:
    """A row per step and delta with the value at step + delta: outside the episode the end value (absolute) or 0 (relative).

    Steps are numbered from 0 without gaps, as index_steps() does; one window over the episode holds all deltas.
    """
    w, whole = episode(), episode().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = {f"_g{i}": F.lead(value, d).over(w) if d > 0 else F.lag(value, -d).over(w) for i, d in enumerate(deltas) if d}
    rows = steps.select(*KEYS, F.col(value).alias("_own"), F.first(value).over(whole).alias("_a"), F.last(value).over(whole).alias("_b"), F.count("*").over(whole).alias("_n"), *[x.alias(c) for c, x in ahead.items()])
    each = []
    for i, d in enumerate(deltas):
        at, inside = F.col(KEYS[1]) + d, F.col(f"_g{i}" if d else "_own")
        absolute = F.when(at < 0, F.col("_a")).when(at >= F.col("_n"), F.col("_b")).otherwise(inside)
        relative = F.when((at >= 0) & (at < F.col("_n")), inside).otherwise(0.0)
        each.append(F.struct(F.lit(d).alias("delta"), absolute.alias("absolute"), relative.alias("relative")))
    return rows.select(*KEYS, F.inline(F.array(*each)))


def gather(steps: DataFrame, value: str, deltas: list[int], absolute: bool = True) -> DataFrame:
    """A row per step and delta: the value at step + delta; outside the episode the end value (absolute) or 0."""
    return gather_ends(steps, value, deltas).select(*KEYS, "delta", F.col("absolute" if absolute else "relative").alias("gathered"))


def sign_continuity(steps: DataFrame, dot: Column) -> DataFrame:
    """+1 or -1 for each step, from the raw dot product with the step before: flipped for each negative one since the last zero."""
    w = episode()
    rows = steps.withColumn("_dot", dot)
    rows = rows.withColumn("_block", F.sum((F.col("_dot") == 0).cast("int")).over(w))
    flips = F.sum((F.col("_dot") < 0).cast("int")).over(Window.partitionBy(KEYS[0], "_block").orderBy(KEYS[1]))
    return rows.withColumn("sign", F.when(F.coalesce(flips, F.lit(0)) % 2 == 1, -1).otherwise(1)).drop("_dot", "_block")


def unwrap_rotations(steps: DataFrame, columns: list[str]) -> DataFrame:
    """Rotation vectors moved by whole turns about their axis to the one nearest the output before: from -2 to 2 turns, the
    first of equals; vectors shorter than 1e-8 stay. Sorted episodes are streamed, as each output depends on the last alone."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        episode, prev = None, None
        for batch in batches:
            raw, ids = batch[columns].to_numpy(float), batch[KEYS[0]].to_numpy()
            out = raw.tolist()
            for i, v in enumerate(raw.tolist()):
                n = math.sqrt(sum(x * x for x in v))
                if ids[i] == episode and n >= 1e-8:
                    turns = [[x + 2 * math.pi * k * x / n for x in v] for k in range(-2, 3)]
                    out[i] = min(turns, key=lambda o: math.dist(o, prev))
                episode, prev = ids[i], out[i]
            batch[columns] = out
            yield batch

    rows = steps.select(*KEYS, *[F.col(c).cast("double") for c in columns])
    return rows.repartition(KEYS[0]).sortWithinPartitions(*KEYS).mapInPandas(fold, rows.schema)


def relative_poses(steps: DataFrame, xyz: list[str], angles: list[str], anchor_every: int | None = None) -> DataFrame:
    """Each step's displacement in the frame of the step before, or of its anchor: the last step of a number that is divisible by
    anchor_every before it. Angles are roll, pitch and yaw; the first step has none."""
    from millrace.functions import geometry as g

    w = episode()
    if anchor_every:
        back = ((F.col(KEYS[1]) - 1) % anchor_every + 1).cast("int")
        before = {c: F.element_at(F.collect_list(c).over(w.rowsBetween(-anchor_every, -1)), -back) for c in xyz + angles}
    else:
        before = {c: F.lag(c).over(w) for c in xyz + angles}
    rows = steps.select(*KEYS, *xyz, *angles, *[v.alias(f"_{c}") for c, v in before.items()]).where(F.col(KEYS[1]) > 0)
    turn = g.transpose(g.euler_to_matrix(*[F.col(f"_{c}") for c in angles]))
    moved = g.apply_matrix(turn, [F.col(c) - F.col(f"_{c}") for c in xyz])
    return rows.select(*KEYS, *[m.alias(f"d{c}") for m, c in zip(moved, xyz, strict=True)])


def pose_vectors(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Two arms of (xyz, xyzw, grip) as two of (xyz, rotation vector): 16 numbers to 12. Null vectors stay null."""
    from millrace.functions import geometry as g

    at = lambda i: F.get(F.col(column), F.lit(i)).cast("double")
    length = [F.sqrt(functools.reduce(operator.add, [at(arm + i) * at(arm + i) for i in range(3, 7)])) for arm in (0, 8)]
    held = rows.withColumns({"_n0": length[0], "_n1": length[1]})
    for k, arm in enumerate((0, 8)):
        turn = g.quaternion_to_axis_angle([at(arm + i) / F.col(f"_n{k}") for i in range(3, 7)])
        held = held.withColumn(f"_t{k}", F.array(*turn))
    parts = [x for k, arm in enumerate((0, 8)) for x in (F.array(*[at(arm + i) for i in range(3)]), F.col(f"_t{k}"))]
    return held.withColumn(name, F.when(F.col(column).isNotNull(), F.concat(*parts))).drop("_n0", "_n1", "_t0", "_t1")
