"""Peak concurrency against a plain count at every moment."""

from __future__ import annotations

import datetime
import random

import pytest

from millrace.llm.concurrency import ALL, UNKNOWN, open_sales, peak_concurrency, sweep
from millrace.llm.scratch import Scratch

COLUMNS = ("nation_id", "from_s", "to_s", "n_open", "open_cents", "high_open", "is_peak")
SCHEMA = "nation_id int, start long, end long, cents long, n string, chunk string, key string, high string"


def plain(rows):
    out, good = set(), [(UNKNOWN if g is None else g, s, e, c or 0) for g, s, e, c in rows if s is not None and (e is None or e > s)]
    for nation in {g for g, *_ in good} | ({ALL} if good else set()):
        own = [r for r in good if nation in (r[0], ALL)]
        found, before = [], (0, 0)
        for t in sorted({s for _, s, _, _ in own} | {e for _, _, e, _ in own if e is not None}):
            live = [c for _, s, e, c in own if s <= t and (e is None or e > t)]
            now = (len(live), sum(live))
            if now != before:
                found.append((t, *now))
            before = now
        for i, (t, n, c) in enumerate(found):
            out.add((nation, t, found[i + 1][0] if i + 1 < len(found) else None, n, c, max(x[1] for x in found[: i + 1]), c == max(x[2] for x in found)))
    return out


def found(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("width", [1, 7, 40, 10_000])
def test_sweep_equals_counts_at_every_moment(spark, width):
    """Ties of starts, ends and both, repeats, one hot nation, negative times and cents, ends at borders of chunks."""
    rng = random.Random(width)
    rows = []
    for _ in range(220):
        s = rng.randint(-50, 120)
        rows.append((rng.choice([1, 1, 1, 2, 3, None]), s, rng.choice([None, s + rng.randint(-3, 60), s + rng.randint(1, 5), 7 * rng.randint(0, 20)]), rng.choice([0, 5, 9, -4, None])))
    rows += [(4, 10, 20, 3), (4, 20, 30, 3), (5, 0, 14, 1)] * 3 + [(None, None, 3, 1), (6, None, None, None), (6, 5, 5, 1)]
    assert found(peak_concurrency(table(spark, rows), width=width)) == plain(rows)


def test_all_of_one_moment_and_no_rows(spark):
    rows = [(7, 60, 120, 1)] * 50
    assert found(peak_concurrency(table(spark, rows), width=60)) == plain(rows)
    assert found(peak_concurrency(table(spark, []))) == set()
    with pytest.raises(ValueError):
        peak_concurrency(table(spark, rows), width=0)


def test_heap_pops_what_is_over():
    """A chunk whose seed holds three sales, of which two end inside."""
    rows = [(1, 0, None, None, 3, 30), (1, 0, None, 5, 1, 10), (1, 0, None, 8, 1, 10), (1, 0, 5, 7, 1, 4), (1, 0, 6, None, 2, 2)]
    assert list(sweep(iter(rows))) == [(1, 0, 5, 6, 3, 24, 3), (1, 0, 6, 7, 5, 26, 5), (1, 0, 7, 8, 4, 22, 5), (1, 0, 8, None, 3, 12, 5)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sales_lines_and_clients(spark, zone):
    """Nulls in every column, repeated lines, unknown clients, sales that end before they start, and totals that are no number."""
    at = lambda d, h=0, m=0, s=0: datetime.datetime(2024, 3, d, h, m, s)
    sales = [(1, 1, 10.006, at(1, 0, 0, 59)), (1, 1, 2.0, at(2)), (2, 2, None, at(9, 2, 30)), (3, None, float("nan"), at(3)), (4, 9, -1.0, at(3)), (None, 1, 1.0, at(4)), (5, 1, 1.0, None), (6, 1, 1.0, at(20)), (7, 3, float("inf"), at(5))]
    lines = [(1, at(5, 1, 1, 1)), (1, at(4, 1, 1, 1)), (1, None), (2, at(3, 3)), (2, at(3, 3)), (None, at(1)), (6, at(1)), (8, at(1))]
    clients = [(1, 11), (2, None), (None, 5), (3, 12), (3, 12)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        s = spark.createDataFrame(sales, "sale_id long, client_id long, total double, sold_at timestamp_ntz")
        l = spark.createDataFrame(lines, "sale_id long, shipped_at timestamp_ntz")
        c = spark.createDataFrame(clients, "client_id long, nation_id int")
        got = sorted(tuple(r) for r in open_sales(s, l, c, Scratch(spark, "test")).select("nation_id", "start", "end", "cents").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    day = lambda d, h=0, m=0: int(at(d, h, m).replace(tzinfo=datetime.UTC).timestamp())
    want = [(11, day(1), day(11, 1, 1), 1001), (11, day(2), day(11, 1, 1), 200), (-1, day(9, 2, 30), day(10, 3), 0), (-1, day(3), None, 0), (-1, day(3), None, -100), (11, day(4), None, 100), (12, day(5), None, 0)]
    assert sorted(got, key=str) == sorted(want, key=str)
