"""Operators against their plain window form, and on edge cases."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from samples import comparable, fare_frame, fare_rows, rows_of, trip_frame, trip_rows

from tripledger.functions import day_type, exact_sum, in_days, total, weekday_name, weekday_number
from tripledger.operators import concurrency, extremes
from tripledger.operators.cleaning import clean, strip_column_names
from tripledger.operators.concurrency import peak_concurrency
from tripledger.operators.extremes import first_per_group, max_per_group, ranked_in_group, top_values_per_group
from tripledger.operators.matching import match_rides
from tripledger.operators.grouping import above_group_mean
from tripledger.operators.profiling import distinct_counts, exact_quartiles, null_rows, profile, value_counts
from tripledger.operators.totals import attach_group_ratio, attach_group_sums, attach_group_total
from tripledger.plans.fares import top_vendor_by_payment_type
from tripledger.plans.rides import driver_of_each_day, trips_above_mean_tip


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third under null, the rest under many keys."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        key = ("hot", None, f"k{rng.randrange(200)}")[i % 3]
        rows.append((key, rng.choice([1, 2, None]), rng.randrange(100), rng.randrange(3)))
    return spark.createDataFrame(rows, "a string, b int, x int, y int").cache()


def test_group_sums_equal_the_window_form(skewed):
    window = Window.partitionBy("a", "b")
    expected = skewed.select("*", F.sum("x").over(window).alias("sx"), F.sum("y").over(window).alias("sy"))
    found = attach_group_sums(skewed, ["a", "b"], {"sx": "x", "sy": "y"})
    assert found.columns == expected.columns
    whole = found.withColumns({name: F.col(name).cast("long") for name in ("sx", "sy")})
    assert comparable(rows_of(whole)) == comparable(rows_of(expected))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_stored_group_total_equals_the_window_form(spark, skewed, threshold):
    """Broadcast or, beyond the threshold, shuffled."""
    expected = skewed.withColumn("sx", F.sum("x").over(Window.partitionBy("a", "b")).cast("double"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = attach_group_total(skewed, ["a", "b"], "x", "sx")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (threshold == "-1")
        assert comparable(rows_of(found)) == comparable(rows_of(expected))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_group_ratio_equals_the_window_form(skewed):
    window = Window.partitionBy("a")
    expected = skewed.withColumn("share", F.try_divide(F.sum("y").over(window), F.sum("x").over(window)) * 100)
    found = attach_group_ratio(skewed, ["a"], "y", "x", "share", scale=100.0)
    assert comparable(rows_of(found)) == comparable(rows_of(expected))


CENTS = [("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", 0.3), ("b", 0.2), ("b", 0.1)]


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_sums_of_cents_tie_however_they_are_added(spark, partitions):
    fares = [dict(fare_rows(1, 1)[0], vendor_id=v, payment_type="CSH", total_amount=x) for v, x in CENTS]
    best = top_vendor_by_payment_type(fare_frame(spark, fares).repartition(partitions)).collect()
    assert sorted((r["vendor_id"], r["sum_total_amount"]) for r in best) == [("a", 0.6), ("b", 0.6)]


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_drivers_with_the_same_cents_tie(spark, partitions):
    fare, trip = fare_rows(1, 1)[0], trip_rows(1, 1)[0]
    start = dt.datetime(2013, 1, 1)
    fares, trips = [], []
    for i, (driver, tip) in enumerate(CENTS):
        ride = {"medallion": "m", "hack_license": driver, "vendor_id": "v", "pickup_datetime": start + dt.timedelta(minutes=i)}
        fares.append(fare | ride | {"tip_amount": tip})
        trips.append(trip | ride | {"dropoff_datetime": start + dt.timedelta(hours=1)})
    best = driver_of_each_day(fare_frame(spark, fares).repartition(partitions), trip_frame(spark, trips))
    assert sorted((r["hack_license"], r["tips_sum"]) for r in best.collect()) == [("a", 0.6), ("b", 0.6)]


@pytest.mark.parametrize(("tip", "rides"), [(0.03, 11), (0.01, 29), (0.07, 3)])
def test_equal_tips_are_not_above_their_mean(spark, tip, rides):
    fare, trip = fare_rows(1, 1)[0], trip_rows(1, 1)[0]
    ride = [{"medallion": "m", "hack_license": "h", "vendor_id": "v", "pickup_datetime": dt.datetime(2013, 1, 1, 0, i)} for i in range(rides)]
    fares = fare_frame(spark, [fare | r | {"tip_amount": tip} for r in ride])
    trips = trip_frame(spark, [trip | r | {"rate_code": 1} for r in ride])
    assert trips_above_mean_tip(fares, trips).collect() == []


def test_weights_beyond_a_bigint(spark):
    rows = [(1, 0.01, 4 * 10**18), (1, 0.02, 4 * 10**18), (1, None, 4 * 10**18)]
    df = spark.createDataFrame(rows, "g int, v double, w long")
    found = above_group_mean(df, "g", "v", "w", "n")
    assert rows_of(found) == [(1, 4 * 10**18)]


def test_exact_amounts_are_never_rounded_or_lost_unseen(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (-3.0000000000000004,)], "x double")
    assert df.agg(exact_sum("x").alias("s")).first()["s"] == Decimal("-2.7")
    for bad in (0.0000001, 1e13, float("nan")):
        with pytest.raises(Exception, match="not an exact amount"):
            spark.createDataFrame([(bad,)], "x double").agg(exact_sum("x")).collect()
    assert spark.createDataFrame([(0.00000012,)], "x double").agg(exact_sum("x", 8).alias("s")).first()["s"] == Decimal("0.00000012")


def test_totals_of_any_doubles(spark):
    odd = [float("nan"), 1.2345678, 1e10, 1e-9, 0.1, 0.2, -0.3, 1e300, -1e300, 12345678901234.5, None]
    groups = {
        "money": [0.1, 0.2, -3.0, None],
        "fractions": [1.2345678, 1e10, 1e-9, 0.1, 1 / 3, -1e10, 5e15, -5e15],
        "nan": odd,
        "infinite": [float("inf"), 1.0, 1e-30],
        "both": [float("inf"), float("-inf")],
        "none": [None, None],
        "huge": [1e300, 1e300],
        "binary": [0.1] * 1000 + [1e-7] * 1000,
    }
    rows = [(g, x) for g, values in groups.items() for x in values]
    answers = []
    for parts in (1, 2, 4, 7):
        frame = spark.createDataFrame(random.Random(parts).sample(rows, len(rows)), "g string, x double").repartition(parts)
        answers.append({r["g"]: repr(r["s"]) for r in frame.groupBy("g").agg(total("x").alias("s")).collect()})
    assert all(a == answers[0] for a in answers)
    found = {g: eval(s, {"nan": math.nan, "inf": math.inf}) for g, s in answers[0].items()}
    assert found["money"] == -2.7 and found["none"] is None and found["infinite"] == math.inf and found["huge"] == 2e300
    assert math.isnan(found["nan"]) and math.isnan(found["both"])
    assert math.isclose(found["fractions"], math.fsum(groups["fractions"]), rel_tol=1e-15)
    assert math.isclose(found["binary"], 100.0001, rel_tol=1e-15)


def test_means_of_odd_values_compare_as_doubles(spark):
    rows = [("a", 0.1, 3), ("b", 1.23456789, 1), ("b", 1.0, 1), ("c", math.nan, 1), ("c", 5.0, 2), ("d", 0.1, 1), ("d", 0.2, 1), ("d", 0.3, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    assert sorted(rows_of(above_group_mean(df, "g", "v", "w", "n"))) == [("b", 1), ("d", 1)]


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 1000])
def test_exact_quartiles(spark, rows):
    rng = random.Random(rows)
    values = [(rng.choice([None, rng.randrange(50) / 4]), rng.randrange(10**9)) for _ in range(rows)]
    df = spark.createDataFrame(values, "a double, b long")
    found = {r["column"]: tuple(r)[1:] for r in exact_quartiles(df, ["a", "b"]).collect()}
    for i, name in enumerate(("a", "b")):
        known = sorted(float(v[i]) for v in values if v[i] is not None)
        ranks = [max(1, math.ceil(q * len(known))) for q in (0.25, 0.5, 0.75)]
        assert found.get(name) == (tuple(known[r - 1] for r in ranks) if known else None)


def test_profile_with_exact_and_estimated_quartiles(spark):
    df = spark.range(1, 101).select("id", F.lit("x").alias("s"))
    for options in ({}, {"accuracy": 10_000}):
        rows = {r["column"]: r for r in profile(df, **options).collect()}
        assert (rows["id"]["p25"], rows["id"]["p50"], rows["id"]["p75"], rows["id"]["distinct"]) == (25.0, 50.0, 75.0, 100)
        assert rows["s"]["p50"] is None and rows["s"]["distinct"] == 1


def test_max_per_group_keeps_ties_and_null_groups_but_no_null_values(spark):
    rows = [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 4.0), (None, 4, 1.0), (None, 5, None), ("b", 6, None)]
    df = spark.createDataFrame(rows, "g string, id int, v double")
    assert comparable(rows_of(max_per_group(df, ["g"], "v"))) == comparable([rows[0], rows[1], rows[3]])


def test_first_per_group_and_ranks(spark):
    rows = [("a", 1, 9), ("a", 2, 9), ("a", 3, 8), ("a", 4, 7), ("b", 5, 1)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    first = first_per_group(df, ["g"], [F.desc("v"), F.asc("id")])
    assert comparable(rows_of(first)) == [rows[0], rows[4]]
    top = ranked_in_group(df, ["g"], ["v"], 3)
    assert comparable(rows_of(top)) == [("a", 1, 9, 1), ("a", 2, 9, 1), ("a", 3, 8, 3), ("b", 5, 1, 1)]


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_top_values_unfold_to_every_row(spark, skewed, monkeypatch, chunk):
    monkeypatch.setattr(extremes, "COPIES_PER_CHUNK", chunk)
    window = Window.partitionBy("a").orderBy(F.desc("b"))
    expected = skewed.withColumn("rank", F.dense_rank().over(window)).where("rank <= 2").select("a", "b", "rank")
    assert comparable(rows_of(top_values_per_group(skewed, ["a"], "b", 2))) == comparable(rows_of(expected))


def one_task_peaks(df):
    starts = df.where("s is not null").select(F.col("s").alias("t"), F.lit(1).alias("d"))
    ends = df.where("e is not null").select(F.col("e").alias("t"), F.lit(-1).alias("d"))
    net = starts.unionAll(ends).groupBy("t").agg(F.sum("d").alias("d"))
    running = net.withColumn("n", F.sum("d").over(Window.orderBy("t")))
    return running.groupBy(F.date_format("t", "yyyy-MM-dd").alias("day")).agg(F.max("n").alias("n"))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_peak_concurrency_equals_one_running_count(spark, kind):
    rng = random.Random(9)
    base = dt.datetime(2013, 3, 9, 23, 59, 58)
    rows = []
    for _ in range(500):
        start = base + dt.timedelta(microseconds=rng.choice([1, 250_000, 1_000_000]) * rng.randrange(20))
        length = dt.timedelta(microseconds=rng.choice([0, 1, 500_000, 3_000_000, 90_000_000_000, 200_000_000_000]))
        end = None if rng.random() < 0.1 else start + length
        rows.append((None if rng.random() < 0.1 else start, end))
    df = spark.createDataFrame(rows, "s timestamp, e timestamp").select(F.col("s").cast(kind), F.col("e").cast(kind))
    assert comparable(rows_of(peak_concurrency(df, "s", "e", "n"))) == comparable(rows_of(one_task_peaks(df)))


def test_chains_of_peak_concurrency_get_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(concurrency, "TASK_ROWS", 20)
    base = dt.datetime(2013, 3, 9)
    rows = [(base + dt.timedelta(hours=5 * i), base + dt.timedelta(hours=5 * i, minutes=i % 500)) for i in range(200)]
    df = spark.createDataFrame(rows, "s timestamp, e timestamp")
    peaks = peak_concurrency(df, "s", "e", "n")
    plan = peaks._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\((?:_second|day)#\d+, 10\)", plan)) == 2
    assert comparable(rows_of(peaks)) == comparable(rows_of(one_task_peaks(df)))


def test_peak_concurrency_of_touching_and_nested_intervals(spark):
    at = lambda hour: dt.datetime(2013, 1, 1) + dt.timedelta(hours=hour)
    rows = [(at(1), at(2)), (at(2), at(3)), (at(2), at(30)), (at(2.5), at(2.75)), (at(26), at(27)), (at(4), at(4))]
    df = spark.createDataFrame(rows, "s timestamp, e timestamp")
    assert sorted(rows_of(peak_concurrency(df, "s", "e", "n"))) == [("2013-01-01", 3), ("2013-01-02", 2)]


def test_peak_concurrency_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The hour from 01:00 occurs twice on this day.
        seconds = [(1383455400, 1383462000), (1383459000, 1383459060), (1383459030, 1383459090)]
        df = spark.createDataFrame(seconds, "s long, e long").select(
            F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e")
        )
        assert rows_of(peak_concurrency(df, "s", "e", "n")) == rows_of(one_task_peaks(df)) == [("2013-11-03", 3)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "keys", [["medallion", "hack_license", "vendor_id", "pickup_datetime"], ["medallion", "hack_license", "pickup_datetime"], ["hack_license", "pickup_datetime"]]
)
def test_match_rides_on_any_keys(spark, keys):
    fares, trips = fare_rows(3, 150), trip_rows(4, 150)
    fare, trip = fare_frame(spark, fares), trip_frame(spark, trips)
    matched = match_rides(fare, trip, keys)
    assert len(set(matched.columns)) == len(matched.columns)
    expected = [
        (f["hack_license"], f["tip_amount"], t["rate_code"])
        for f in fares
        for t in trips
        if all(f[k] is not None and f[k] == t[k] for k in keys)
    ]
    assert expected
    assert comparable(rows_of(matched, "hack_license", "tip_amount", "rate_code")) == comparable(expected)
    narrow = match_rides(fare, trip, keys, ["tip_amount"], ["rate_code"])
    assert narrow.columns == [*keys, "tip_amount", "rate_code"]
    assert narrow.count() == len(expected)


def test_clean(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("a", None), (None, None), (None, None), (None, 2)]
    df = spark.createDataFrame(rows, "x string, y int")
    assert comparable(rows_of(clean(df))) == comparable([("a", 1), ("a", None), (None, 2)])
    assert rows_of(clean(df, how="any")) == [("a", 1)]


def test_strip_column_names(spark):
    assert strip_column_names(spark.createDataFrame([(1, 2, 3)], ["a", " b", "  c d "])).columns == ["a", "b", "c d"]


def test_weekdays(spark):
    days = [dt.datetime(2013, 1, d) for d in (4, 5, 6, 7)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp")
    found = rows_of(df.select(weekday_number("t"), weekday_name(weekday_number("t")), day_type("t")))
    assert found == [
        (6, "Friday", "weekday"),
        (7, "Saturday", "weekend"),
        (1, "Sunday", "weekend"),
        (2, "Monday", "weekday"),
        (None, None, "weekend"),
    ]
    same = df.where(F.col("t").isNotNull() & (weekday_name(weekday_number("t")) != F.date_format("t", "EEEE")))
    assert same.count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_day_range_on_both_timestamp_types(spark, kind):
    df = spark.createDataFrame([(dt.datetime(2013, 1, 7, 23, 59, 59),), (dt.datetime(2013, 1, 8),)], "t timestamp")
    df = df.select(F.col("t").cast(kind))
    assert df.where(in_days(df, "t", dt.date(2013, 1, 7), dt.date(2013, 1, 7))).count() == 1


PROFILE_ROWS = [
    ("b", 1, 1.5, dt.datetime(2013, 1, 1), None),
    ("a", 2, None, dt.datetime(2013, 1, 2), None),
    ("a", None, 4.5, None, None),
    (None, 2, 3.0, dt.datetime(2013, 1, 1), None),
]
PROFILE_SCHEMA = "s string, i int, d double, t timestamp, n double"


@pytest.mark.parametrize("exact", [True, False])
def test_profile(spark, exact):
    found = {r["column"]: r for r in profile(spark.createDataFrame(PROFILE_ROWS, PROFILE_SCHEMA), exact_distinct=exact).collect()}
    assert list(found["s"].asDict()) == [
        "column", "type", "rows", "nulls", "distinct", "min", "max", "mean", "stddev", "p25", "p50", "p75"
    ]
    assert tuple(found["s"]) == ("s", "string", 4, 1, 3, "a", "b", None, None, None, None, None)
    assert tuple(found["i"])[:7] == ("i", "int", 4, 1, 3, "1", "2")
    assert found["i"]["mean"] == pytest.approx(5 / 3)
    assert tuple(found["d"]) == ("d", "double", 4, 1, 4, "1.5", "4.5", 3.0, 1.5, 1.5, 3.0, 4.5)
    assert tuple(found["t"])[:7] == ("t", "timestamp", 4, 1, 3, "2013-01-01 00:00:00", "2013-01-02 00:00:00")
    assert tuple(found["n"]) == ("n", "double", 4, 4, 1, None, None, None, None, None, None, None)


def test_profile_agrees_with_summary(spark):
    df = fare_frame(spark, fare_rows(8, 300))
    summary = {r["summary"]: r["fare_amount"] for r in df.select("fare_amount").summary().collect()}
    row = profile(df, ["fare_amount"]).first()
    assert int(summary["count"]) == row["rows"] - row["nulls"]
    for theirs, ours in {"mean": "mean", "stddev": "stddev", "25%": "p25", "50%": "p50", "75%": "p75"}.items():
        assert float(summary[theirs]) == pytest.approx(row[ours])
    assert (float(summary["min"]), float(summary["max"])) == (float(row["min"]), float(row["max"]))


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_an_empty_table(spark, exact):
    df = spark.createDataFrame([], PROFILE_SCHEMA)
    rows = profile(df, exact_distinct=exact).collect()
    assert [(r["rows"], r["nulls"], r["distinct"], r["min"], r["mean"]) for r in rows] == [(0, 0, 0, None, None)] * 5


def test_distinct_counts_equal_distinct(spark):
    df = fare_frame(spark, fare_rows(2, 300))
    found = dict(rows_of(distinct_counts(df)))
    assert found == {c: df.select(c).distinct().count() for c in df.columns}


def test_value_counts_and_null_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "x string, y int")
    assert comparable(rows_of(value_counts(df, "x"))) == comparable([("a", 2), (None, 1)])
    assert rows_of(null_rows(df, "x")) == [(None, 3)]
