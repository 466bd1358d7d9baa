"""Interval join: an event is one row for each level of its own key, not of all keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recordbridge.functions import dates
from recordbridge.operators import joins

FIRST = dt.date(2020, 1, 1)


@pytest.mark.parametrize("dense", [1000, 5])
def test_levels_by_key_against_brute_force(make, rows, monkeypatch, dense):
    """Keys with few blocks, with one level above 0, with spans to the year 9999, and with many levels; a null key too."""
    monkeypatch.setattr(joins, "DENSE", dense)
    rnd = random.Random(5)
    day = lambda n=900: FIRST + dt.timedelta(days=rnd.randrange(n))
    spans = [(k, j, day(), rnd.choice([None, day(), dt.date(9999, 12, 31)] if k != 1 else [day()])) for j in range(60) for k in [rnd.choice([None, 1, 2, 3, 3, 3])]]
    events = [(rnd.choice([None, 1, 2, 3, 4]), i, rnd.choice([None, day(), day(9000)])) for i in range(200)]
    want = sorted(((e, s) for k, e, at in events for q, s, lo, hi in spans if k == q and at and lo <= at <= (hi or dt.date(2021, 12, 1))), key=repr)
    out = joins.interval_join(make("k int, e int, at date", *events), make("k int, s int, lo date, hi date", *spans), "k", "at", "lo", "hi", dates.day("2021-12-01"), 2)
    assert want and rows(out.select("e", "s")) == want


def test_a_long_span_of_one_key_leaves_the_others_alone(make, spark):
    """Events of key 1 make one row each, though key 2 has spans on many levels."""
    short = [(1, FIRST + dt.timedelta(days=i), FIRST + dt.timedelta(days=i)) for i in range(20)]
    long = [(2, FIRST + dt.timedelta(days=i), FIRST + dt.timedelta(days=900 * i + 400)) for i in range(20)]
    spans = make("k int, lo date, hi date", *short, *long)
    events = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("e"), F.date_add(F.lit(FIRST), (F.col("id") % 20).cast("int")).alias("at"))
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda e: (seen.add(1), e)[1], "long").asNondeterministic()
    kept = joins.ns_join
    try:
        # Counts the event rows that go into the join on blocks.
        joins.ns_join = lambda left, right, on, *rest, **more: kept(left.withColumn("e", count("e")) if "__bin" in on else left, right, on, *rest, **more)
        out = joins.interval_join(events, spans, "k", "at", "lo", "hi", dates.day("2020-12-31"), 1)
    finally:
        joins.ns_join = kept
    assert out.count() == 1000 and len(out.select("e").collect()) == 1000
    assert seen.value <= 2000
