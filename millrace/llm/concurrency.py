"""Peak concurrency: how many sales are open at a time, by a sweep with a min-heap of ends.

Time is cut into chunks of a fixed width. Sales of equal nation, start and end are counted together first, so a chunk has
at most (minutes of the width) ** 2 / 2 records whatever the size of the input, and a nation with most of the sales is as
many groups as any other. A chunk is seeded with the sales that are open at its left border: those that end inside it go into
the heap of ends one by one, the others only count, as one total that running sums over the chunks' totals give.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from millrace.llm import textops as T
from millrace.llm.scratch import Scratch

#: Group of all sales, and of those whose client has no nation.
ALL, UNKNOWN = -2, -1
SWEPT = pa.schema([("nation_id", pa.int32()), ("chunk", pa.int64()), ("from_s", pa.int64()), ("to_s", pa.int64()), ("n_open", pa.int64()), ("open_cents", pa.int64()), ("high", pa.int64())])
#: Rows of an Arrow batch that the sweep gives out.
BATCH = 8192


def minute_s(rows: DataFrame, name: str) -> Column:
    """UTC seconds since 1970 of a column, rounded down to a minute. Times without a zone are UTC in any session."""
    t = F.col(name)
    if isinstance(rows.schema[name].dataType, S.TimestampNTZType):
        return F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    s = F.unix_seconds(t)
    return s - F.pmod(s, F.lit(60))


def chunk_of(s: Column, width: int) -> Column:
    return ((s - F.pmod(s, F.lit(width))) / width).cast("long")


def open_sales(sales: DataFrame, sale_lines: DataFrame, clients: DataFrame, scratch: Scratch, days: int = 7) -> DataFrame:
    """nation_id, start, end (null: never) and cents of every sale that is open at some time.

    The looked-up tables (a row per sale, a row per client) are written first: a join whose sides are both freshly dealt out is one of
    which Spark splits the partition of a hot sale or client.
    """
    shipped = sale_lines.where("sale_id is not null and shipped_at is not null").select("sale_id", minute_s(sale_lines, "shipped_at").alias("at"))
    ends = shipped.groupBy("sale_id").agg((F.min("at") + days * 86400).alias("end"))
    nations = clients.where("client_id is not null").groupBy("client_id").agg(F.min("nation_id").cast("int").alias("nation_id"))
    amount = F.floor(100 * F.col("total") + 0.5).cast("long")
    usable = F.col("total").isNotNull() & ~F.isnan("total") & (F.abs("total") < 9e16)
    rows = sales.where("sold_at is not null").select("sale_id", "client_id", minute_s(sales, "sold_at").alias("start"), F.when(usable, amount).otherwise(F.lit(0)).alias("cents"))
    rows = rows.join(scratch.save(ends), "sale_id", "left").where("end is null or end > start").select("client_id", "start", "end", "cents")
    return rows.join(scratch.save(nations), "client_id", "left").select(F.coalesce("nation_id", F.lit(UNKNOWN)).alias("nation_id"), "start", "end", "cents")


def chunk_records(intervals: DataFrame, width: int) -> DataFrame:
    """Intervals (nation_id, start, end, cents) as records of chunks, equal ones summed up.

    An interval is a start in one chunk, with its end if that is in the same chunk, and else an end in another chunk, whose seed it is
    part of. Each counts for its nation and for ALL.
    """
    counted = intervals.groupBy("nation_id", "start", "end").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    first, last = chunk_of(F.col("start"), width), chunk_of(F.col("end"), width)
    none = F.lit(None).cast("long")
    within = F.struct(first.alias("chunk"), F.col("start").alias("start"), F.when(first == last, F.col("end")).alias("end"))
    after = F.struct(last.alias("chunk"), none.alias("start"), F.col("end").alias("end"))
    records = F.when(F.col("end").isNotNull() & (first != last), F.array(within, after)).otherwise(F.array(within))
    both = F.array(F.col("nation_id"), F.lit(ALL).cast("int"))
    rows = counted.select("nation_id", F.explode(records).alias("r"), "n", "cents").select(F.explode(both).alias("nation_id"), "r.*", "n", "cents")
    return rows.groupBy("nation_id", "chunk", "start", "end").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))


def seeds(records: DataFrame) -> DataFrame:
    """What is open at the left border of each chunk: a record without start and end. One row per nation and chunk is summed up."""
    began, ended = F.col("start").isNotNull(), F.col("end").isNotNull()
    change = lambda c: F.sum(F.when(began & ended, 0).when(began, F.col(c)).otherwise(-F.col(c)))
    totals = records.groupBy("nation_id", "chunk").agg(change("n").alias("n"), change("cents").alias("cents"))
    before = Window.partitionBy("nation_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(None).cast("long")
    return totals.select("nation_id", "chunk", none.alias("start"), none.alias("end"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("cents").over(before), F.lit(0)).alias("cents"))


def sweep(records: Iterator[tuple]) -> Iterator[tuple]:
    """(nation, chunk, from, to, n_open, open_cents, highest n_open so far) at every change within each chunk.

    records: (nation, chunk, start, end, n, cents), of a chunk together: first the seed's total, then the seed's ends, then starts in
    their order. Ends of sales that are over by a start are popped before it. `to` is null in a chunk's last row.
    """
    heap: list[tuple[int, int, int]] = []
    key, n_open, cents_open, high = None, 0, 0, None
    now, dn, dc, last = None, 0, 0, None  # the moment that is being summed up, and the row that waits for its `to`

    def settle(at: int | None) -> Iterator[tuple]:
        """Leave the moment `now` for `at`."""
        nonlocal n_open, cents_open, high, now, dn, dc, last
        if at != now:
            if dn or dc:
                n_open, cents_open = n_open + dn, cents_open + dc
                high = n_open if high is None else max(high, n_open)
                if last:
                    yield (*last[:3], now, *last[3:])
                last = (*key, now, n_open, cents_open, high)
            now, dn, dc = at, 0, 0

    def pop(until: int | None) -> Iterator[tuple]:
        nonlocal dn, dc
        while heap and (until is None or heap[0][0] <= until):
            end, n, cents = heapq.heappop(heap)
            yield from settle(end)
            dn, dc = dn - n, dc - cents

    def close() -> Iterator[tuple]:
        nonlocal last
        yield from pop(None)
        yield from settle(None)
        if last:
            yield (*last[:3], None, *last[3:])
        last = None

    for nation, chunk, start, end, n, cents in records:
        if (nation, chunk) != key:
            yield from close()
            key, n_open, cents_open, high = (nation, chunk), 0, 0, None
        if start is None and end is None:
            n_open, cents_open = n, cents
            continue
        if start is not None:
            yield from pop(start)
            yield from settle(start)
            dn, dc = dn + n, dc + cents
        if end is not None:
            heapq.heappush(heap, (end, n, cents))
    yield from close()


def sweep_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sweep(r for batch in it for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SWEPT, strict=True)], schema=SWEPT)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SWEPT, strict=True)], schema=SWEPT)


def peak_concurrency(intervals: DataFrame, width: int = 6 * 3600) -> DataFrame:
    """How many intervals (nation_id, start, end in seconds, cents) are open at every moment, by nation and for all (-2).

    Returns a row per nation and moment from_s at which the number or the cents of open intervals change: nation_id, from_s, to_s
    (the nation's next moment; null in its last row), n_open, open_cents, high_open (the largest n_open so far) and is_peak
    (whether open_cents is the nation's largest).

    An interval is open from start up to, not including, end; with a null end for ever. Equal intervals count as often as they
    occur. Starts and ends of one moment are taken together, and a moment at which they cancel out has no row. An interval without
    start, or whose end is not after it, takes no part. Null nations count as -1, null cents as 0. Other columns are ignored. An
    empty table gives no rows.

    `width` is the width of a chunk in seconds; results do not depend on it. A task sweeps whole chunks; what grows with the
    span of time alone is a row per nation and chunk.
    """
    if width <= 0:
        raise ValueError("width must be positive")
    rows = intervals.where("start is not null and (end is null or end > start)")
    rows = rows.select(F.coalesce(F.col("nation_id").cast("int"), F.lit(UNKNOWN)).alias("nation_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce(F.col("cents").cast("long"), F.lit(0)).alias("cents"))
    scratch = Scratch(intervals.sparkSession, "concurrency")
    records = scratch.save(chunk_records(rows, width))
    keys = ["nation_id", "chunk"]
    ordered = records.unionByName(seeds(records)).repartition(*keys).sortWithinPartitions(*keys, F.col("start").asc_nulls_first(), F.col("end").asc_nulls_first())
    swept = scratch.save(ordered.select("nation_id", "chunk", "start", "end", "n", "cents").mapInArrow(T.lean(sweep_batches), "nation_id int, chunk long, from_s long, to_s long, n_open long, open_cents long, high long"))
    scratch.drop(records)
    chunks = swept.groupBy(*keys).agg(F.min("from_s").alias("first"), F.max("high").alias("most"), F.max("open_cents").alias("cents"))
    order, nation = Window.partitionBy("nation_id").orderBy("chunk"), Window.partitionBy("nation_id")
    around = chunks.select(
        *keys,
        F.lead("first").over(order).alias("next"),
        F.max("most").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.max("cents").over(nation).alias("peak"),
    )
    return swept.join(around, keys).select(
        "nation_id", "from_s", F.coalesce("to_s", "next").alias("to_s"), "n_open", "open_cents", F.greatest("high", "before").alias("high_open"), (F.col("open_cents") == F.col("peak")).alias("is_peak")
    )


def op11(spark, sf_dir: str) -> DataFrame:
    """Open sales by nation; a client's nation is the smallest that its rows name, a total that is not a number counts as 0."""
    sales, lines, clients = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("sales", "sale_lines", "clients"))
    return peak_concurrency(open_sales(sales, lines, clients, Scratch(spark, "open-sales")))
