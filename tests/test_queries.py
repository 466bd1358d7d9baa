"""Every query beside its SQL, and the form of the plans."""

import re

import pytest
from oracle import compare, connect
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from recordbridge.operators import groups, joins
from recordbridge.registry import ORACLE, QUERIES

SMALL, CHECKED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(CHECKED)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, CHECKED), con, ORACLE[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_scales(spark, name, monkeypatch):
    """Of the query itself, and of every table that it writes on its way."""
    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (plans.append(plan(self._df)), write(self, *a, **b))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans.append(plan(QUERIES[name](spark, SMALL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in plans:
        for operator in ("NestedLoop", "CartesianProduct", "PythonUDF", "ArrowEval", "MapInPandas"):
            assert operator not in text
        # The only whole-table window adds up the row counts of partitions.
        for found in re.findall(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", text):
            assert "__part" in found


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["active_filter"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in text and "o_totalprice" not in text


def test_first_rows_are_pruned_before_the_shuffle(spark):
    text = plan(QUERIES["distinct_keep_first"](spark, SMALL))
    assert re.search(r"WindowGroupLimit[^\n]*Final(?s:.*)Exchange hashpart(?s:.*)WindowGroupLimit[^\n]*Partial", text)


@pytest.fixture
def skew(spark):
    """Thresholds so low that a hot key of the test shows."""
    knobs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in knobs.items():
        spark.conf.set(k, v)
    yield
    for k in knobs:
        spark.conf.unset(k)


@pytest.fixture
def hot(spark):
    """A third of the rows under one key, half of those at one moment."""
    i = F.col("id")
    return spark.range(0, 240_000, 1, 16).select(
        F.when(i % 3 == 0, F.lit(-1)).otherwise(i).alias("k"), F.when(i % 6 == 0, F.lit(10**9)).otherwise(i).alias("at"), i.alias("v"),
        F.sha2(i.cast("string"), 256).alias("text"),
    )


def counted(df, key):
    """Row counts by a key, from an aggregate that needs the rows' text, and the final plan."""
    out = df.groupBy(key).agg(F.count("*").alias("count"), F.max("text"))
    return {tuple(r)[:2] for r in out.collect()}, plan(out)


def test_group_values_on_a_hot_key(skew, hot):
    got, text = counted(groups.with_group(hot, ["k"], {"n": F.count("*")}), F.col("n"))
    assert got == {(80_000, 80_000), (1, 160_000)} and "skew=true" in text


def test_numbers_of_a_hot_key_spread(spark, hot):
    """80,000 of 240,000 rows under one key, 40,000 of them at one moment: no sorted part holds a third, all numbers are there."""
    _, places = groups._places(hot, ["k", "at"], ["k"], False)
    sizes = [r.n for r in places.where("k = -1").groupBy("__part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 2 and max(sizes) < 50_000
    out = groups.seq_in_group(hot, ["k"], ["at"]).where("k = -1").agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.count("*")).head()
    assert tuple(out) == (1, 80_000, 80_000, 80_000)
    low, high = (groups.seq_in_group(hot, ["k"], ["at"]).where("k = -1").agg(f(F.when(F.col("at") < 10**9, F.col("n")))).head()[0] for f in (F.min, F.max))
    assert (low, high) == (1, 40_000)


def test_ids_write_each_row_once(spark, hot, monkeypatch):
    """Behind the sort only marks and places are written."""
    written = []
    keep = groups.materialise
    monkeypatch.setattr(groups, "materialise", lambda df, label: (written.append(df.columns), keep(df, label))[1])
    out = groups.surrogate_id(hot, ["at", "v"], "id")
    assert written == [["k", "at", "v", "text", "__row"], ["__row", "__at"]]
    assert out.agg(F.min("id"), F.max("id"), F.count_distinct("id")).head()[:3] == (1, 240_000, 240_000)


def test_latest_with_ties_on_a_hot_key(skew, hot):
    got, text = counted(groups.latest(hot, ["k"], "at", many_ties=True), F.col("k") == -1)
    assert got == {(True, 40_000), (False, 160_000)} and "skew=true" in text


def test_anti_join_on_a_hot_key(skew, hot):
    got, text = counted(joins.anti_exclude(hot, hot.where("v < 60000 AND k <> -1").select("k"), "k"), F.col("k") == -1)
    assert got == {(True, 80_000), (False, 120_000)} and "skew=true" in text


def test_interval_join_spreads_a_hot_key(spark, hot):
    """Events of one key over 240,000 minutes: the join partitions by bin, not by key alone."""
    minute = F.timestamp_seconds(F.col("v") * 60)
    events = hot.select(F.lit(1).alias("k"), "v", minute.alias("at"))
    spans = spark.range(10).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 86_400 * 10).alias("lo"), F.timestamp_seconds(F.col("id") * 86_400 * 10 + 86_400).alias("hi"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.interval_join(events, spans, "k", "at", "lo", "hi", F.current_date(), bin_days=5)
        assert "__bin" in re.search(r"SortMergeJoin[^\n]*", plan(out)).group(0)
        assert out.count() == 10 * 1441
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_are_not_shuffled(spark):
    """Screening and client answers by client, from buckets by client: no exchange but that of broadcast lookups."""
    from recordbridge.functions import dates
    from recordbridge.plans import assessments, clients
    from recordbridge.registry import jobs
    from recordbridge.registry.base import Tables
    from recordbridge.sources import buckets

    t = Tables(spark, CHECKED)
    kept = buckets.bucketed_dump(spark, {"answers": jobs.answers(t), "people": jobs.people(t)}, "client_id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")  # for the crosswalk of a few rows
    try:
        wide = clients.client_custom(kept["answers"], kept["people"], dates.day("2021-06-07"), jobs.CLIENT_QUESTIONS, ["c_when"], {}, numbered=False)
        screening = assessments.covid_screening(kept["answers"], kept["people"], readers_literal(spark), jobs.SCREENING, numbered=False, date_question="signup")
        for df in (wide, screening):
            text = plan(df)
            assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
            assert df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def readers_literal(spark):
    from recordbridge.sources.readers import literal_table

    return literal_table(spark, [(1, 10)], "Legacy_ProgramID long, Target_AgencyID long")
