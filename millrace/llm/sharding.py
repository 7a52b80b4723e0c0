"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by its hash; then, round by round, a group's
documents move to the shard where most of their neighbours are, as far as that shard's quota allows. At last a shard's
documents are numbered, well linked ones first, and what exceeds its quota fills the shards that have room, so that the
counts of any two shards differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.joins import lookup
from millrace.llm.scratch import Scratch


def by_shard(values: list[float]) -> Column:
    """values[shard] as an expression."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("shard") + 1)


def number_runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each shard within a sorted partition."""
    shard, n = None, 0
    for batch in it:
        s = batch.column(0).to_numpy()
        head = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
        place = np.arange(len(s)) - np.repeat(head, np.diff(np.append(head, len(s))))
        if len(s):
            if s[0] == shard:
                to = head[1] if len(head) > 1 else len(s)
                place[:to] += n
            shard, n = s[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])


def propagate(linked: DataFrame, groups: DataFrame, total: int, quotas: list[int], rounds: int, scratch: Scratch) -> DataFrame:
    """Move linked documents (doc_id, size, crc, grp, shard) towards their neighbours' shards."""
    shards = len(quotas)
    for r in range(rounds):
        spread = scratch.save(linked.groupBy("grp", "shard").count())
        most = spread.groupBy("grp").agg(F.max(F.struct("count", (-F.col("shard")).alias("s"))).alias("m"), F.sum("count").alias("n"))
        target = most.select("grp", (-F.col("m.s")).alias("shard"), (F.col("n") - F.col("m.count")).alias("movers"), "n")
        target = scratch.save(target)
        load, demand = [0.0] * shards, [0.0] * shards
        for s, n in spread.groupBy("shard").agg(F.sum("count")).collect():  # a row per shard
            load[s] = n
        for s, n in target.groupBy("shard").agg(F.sum("movers")).collect():
            demand[s] = n
        if not sum(demand):
            break
        room = [max(0.0, q - x) for q, x in zip(quotas, load, strict=True)]
        share = [min(1.0, x / d) if d else 0.0 for x, d in zip(room, demand, strict=True)]
        target = target.where("movers > 0").select(
            "grp", F.col("shard").alias("to"), by_shard(share).alias("share"), (F.col("movers") * 8 > by_shard(room)).alias("large"), "n"
        )
        stay = groups.join(target.select("grp"), "grp", "left_anti").select("grp", F.lit(None).cast("int").alias("to"), F.lit(0.0).alias("share"), F.lit(False).alias("large"), "n")
        rows = lookup(linked, target.unionByName(stay), "grp", "n", total)
        # a small group moves as one; of a group that would take much of the room, each document is drawn by itself
        draw = F.pmod(F.xxhash64(F.lit(r), F.col("grp"), F.when(F.col("large"), F.col("doc_id"))), F.lit(1 << 20)) / (1 << 20)
        linked = scratch.save(rows.withColumn("shard", F.when(F.col("to").isNotNull() & (draw < F.col("share")), F.col("to")).otherwise(F.col("shard"))).select(*linked.columns))
    return linked


def balanced_shards(docs: DataFrame, shards: int = 16, rounds: int = 4) -> DataFrame:
    """Put each row of docs (doc_id, text) into a shard; equal texts stay together where the counts allow.

    Returns doc_id, size (UTF-8 bytes of the text, plus 1), text_crc32, law ("rows": the shards' counts differ by one at
    most), shard, slot (its place in the shard, from 0 without gaps) and grown_shard (null; other laws would use it).

    A null text has no bytes and crc32 0; null texts are linked with each other. A group that is larger than a shard is spread.
    A null doc_id is like any other. Repeated rows are rows of their own, linked by their text. Other columns are ignored. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
        F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("grp"),
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "grp", F.lit(7)), F.lit(shards)).cast("int"))
    rows = scratch.save(rows)
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = scratch.save(rows.groupBy("grp").agg(F.count("*").alias("n")))
    marked = scratch.save(lookup(rows, groups.withColumn("linked", F.col("n") > 1), "grp", "n", total))
    linked = propagate(marked.where("linked").drop("linked"), groups.where("n > 1"), total, quotas, rounds, scratch)
    near = linked.groupBy("grp", "shard").agg(F.count("*").alias("n")).withColumn("key", F.xxhash64("grp", "shard"))
    placed = lookup(linked.withColumn("key", F.xxhash64("grp", "shard")), near.select("key", F.col("n").alias("near"), "n"), "key", "n", total)
    alone = marked.where("not linked").select("doc_id", "size", "crc", "grp", "shard", F.lit(1).cast("long").alias("near"))
    placed = scratch.save(placed.select(*alone.columns).unionByName(alone))
    keys = [F.col("shard"), F.col("near").desc(), F.col("grp"), F.col("doc_id")]
    parts = max(1, total // 200_000 + 1) if total < 1_600_000 else total // 200_000
    ordered = placed.select("shard", "near", "grp", "doc_id", "size", "crc").repartitionByRange(max(parts, 8), *keys).sortWithinPartitions(*keys)
    ddl = "shard int, near long, grp long, doc_id long, size long, crc long, place long"
    numbered = scratch.save(ordered.mapInArrow(T.lean(number_runs), ddl).withColumn("pid", F.spark_partition_id()))
    counts = numbered.groupBy("pid", "shard").agg(F.count("*").alias("n")).collect()  # a row per partition, and per shard border
    held, before = [0] * shards, []
    for pid, s, n in sorted(counts):
        before.append((pid, s, held[s]))
        held[s] += n
    over = [max(0, h - q) for h, q in zip(held, quotas, strict=True)]
    lack = [max(0, q - h) for h, q in zip(held, quotas, strict=True)]
    over_before, lack_before = np.append(0, np.cumsum(over)).tolist(), np.append(0, np.cumsum(lack)).tolist()
    table = spark.createDataFrame(before, "pid int, shard int, before long")
    ranked = numbered.join(F.broadcast(table), ["pid", "shard"]).withColumn("rank", F.col("place") + F.col("before"))
    spare = F.col("rank") - by_shard(quotas).cast("long") + by_shard(over_before[:-1]).cast("long")  # number of a row that exceeds its shard's quota
    to, slot = F.col("shard"), F.col("rank")
    exceeds = F.col("rank") >= by_shard(quotas)
    for s in range(shards):
        if lack[s]:
            here = exceeds & (spare >= lack_before[s]) & (spare < lack_before[s + 1])
            to, slot = F.when(here, F.lit(s)).otherwise(to), F.when(here, spare - lack_before[s] + held[s]).otherwise(slot)
    return ranked.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), to.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return balanced_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
