"""Tables kept together, copies kept clean, totals kept up."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from samples import rows_of

from tripledger.functions import total
from tripledger.operators.cleaning import clean
from tripledger.operators.kept_totals import add_load, kept_totals
from tripledger.operators.kept_profile import RANK_ERROR, add_load_profile, kept_profile
from tripledger.plans.catalog import QUESTIONS
from tripledger.schema import PADDED_FARE_SCHEMA
from tripledger.sources import arrivals as arriving
from tripledger.sources import bucketed, materialize, read_csv, write_csv, write_parquet
from tripledger.sources.arrivals import add_arrivals
from tripledger.sources.bucketed import co_locate, co_located, even_keys, open_bucketed
from tripledger.sources.csv_files import rejected_cells
from tripledger.sources.lineitem import fare_table, trip_table
from tripledger.sources.scratch import scratch_path

SF_DIR = "/root/testdata/sf0.001"
JOINED = ["rides_by_rate_code", "top_drivers_by_vendor", "driver_of_each_day", "fare_per_second_by_vendor", "top_totals_of_large_parties"]


def exchanges_below_joins(plan):
    """Exchanges in the subtrees of the joins of a physical plan that have no other join below."""
    found, lines = [], plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Join" in line:
            ends = (k for k in range(i + 1, len(lines)) if depth(lines[k]) <= depth(line))
            below = lines[i + 1 : next(ends, len(lines))]
            if not any("Join" in other for other in below):
                found += [other.strip() for other in below if "Exchange" in other]
    return found


@pytest.fixture(scope="module")
def tables(spark):
    fare, trip = (materialize(make(spark, SF_DIR), scratch_path(spark, "copy")) for make in (fare_table, trip_table))
    folder = scratch_path(spark, "bucketed")
    return (fare, trip), co_locate(fare, trip, folder, "kept", 4), folder


@pytest.mark.parametrize("name", JOINED)
def test_joins_of_co_located_copies_move_no_row(spark, tables, name):
    (fare, trip), (near_fare, near_trip), _ = tables
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with co_located(spark):
            answer = QUESTIONS[name](near_fare, near_trip)
            plan = answer._jdf.queryExecution().executedPlan().toString()
            got = rows_of(answer)
        apart = QUESTIONS[name](fare, trip)._jdf.queryExecution().executedPlan().toString()
        assert got == rows_of(QUESTIONS[name](fare, trip))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and exchanges_below_joins(apart) and not exchanges_below_joins(plan)


def test_a_key_too_large_for_a_bucket_stays_out(spark, tables):
    (fare, trip), (near_fare, _), folder = tables
    assert near_fare is not fare
    hot = fare.withColumn("hack_license", F.lit("h")).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    assert not even_keys(hot, ["hack_license", "pickup_datetime"], 8) and even_keys(hot.limit(0), ["hack_license"], 8)
    assert co_locate(hot, trip, scratch_path(spark, "hot"), "hot", 8) == (hot, trip)
    again = open_bucketed(spark, "kept_again", f"{folder}/fare", ["hack_license", "pickup_datetime"], 4)
    assert again.count() == near_fare.count() and again.schema == near_fare.schema


def test_buckets_grow_with_the_rows(spark, tables, monkeypatch):
    """A bucket is one task's, so larger tables have more of them; a key larger than such a bucket stays out."""
    (fare, trip), _, _ = tables
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 500)
    near_fare, near_trip = co_locate(fare, trip, scratch_path(spark, "grown"), "grown", 4)
    rows = max(fare.count(), trip.count())
    for near, whole in ((near_fare, fare), (near_trip, trip)):
        assert len(near.inputFiles()) == -(-rows // 500) > 4 and sorted(map(repr, near.collect())) == sorted(map(repr, whole.collect()))
        assert max(r["count"] for r in near.groupBy(F.input_file_name()).count().collect()) <= 4 * 500
    with co_located(spark):
        assert sorted(rows_of(QUESTIONS["driver_of_each_day"](near_fare, near_trip))) == sorted(rows_of(QUESTIONS["driver_of_each_day"](fare, trip)))
    often = fare.withColumns({"hack_license": F.when(F.rand(1) < 0.45, "h").otherwise(F.col("hack_license")), "pickup_datetime": F.lit(None).cast("timestamp_ntz")})
    assert even_keys(often, ["hack_license", "pickup_datetime"], 4)
    assert co_locate(often, trip, scratch_path(spark, "often"), "often", 4) == (often, trip)


def arrivals(seed):
    draw = random.Random(seed)
    day = dt.datetime(2013, 1, 1)
    return [
        (draw.choice([None, day + dt.timedelta(hours=draw.randint(0, 30))]), draw.choice([None, "a", "b"]), draw.choice([None, 1.5, math.nan]))
        for _ in range(120)
    ]


@pytest.mark.parametrize("how", ["all", "any"])
def test_arrivals_leave_what_one_cleaning_does(spark, how):
    loads = [spark.createDataFrame(arrivals(seed), "t timestamp_ntz, k string, x double") for seed in (1, 2, 3)]
    path = scratch_path(spark, "copy")
    materialize(loads[0], path, how=how, cluster_by=["t"])
    for load in (*loads[1:], loads[1]):
        copy = add_arrivals(load, path, ["t"], how=how)
    whole = clean(loads[0].unionAll(loads[1]).unionAll(loads[2]), how=how)
    assert sorted(map(repr, copy.collect())) == sorted(map(repr, whole.collect()))
    assert add_arrivals(loads[0].limit(0), path, ["t"], how=how).count() == whole.count()


def test_arrivals_are_shuffled_with_the_copy_once(spark, monkeypatch):
    """Arrivals meet each other and the copy in one shuffle of whole rows, without a join; another deals out the new rows. Nothing else is stored."""
    plans = []

    def planned(df, path, mode):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write_parquet(df, path, mode=mode)

    path = scratch_path(spark, "copy")
    materialize(spark.createDataFrame(arrivals(1), "t timestamp_ntz, k string, x double"), path, cluster_by=["t"])
    monkeypatch.setattr(arriving, "write_parquet", planned)
    add_arrivals(spark.createDataFrame(arrivals(2), "t timestamp_ntz, k string, x double"), path, ["t"])
    assert len(plans) == 1 and "Join" not in plans[0]
    assert plans[0].count("hashpartitioning") == 1 and plans[0].count("rangepartitioning") == 1


def test_arrivals_read_only_their_range(spark):
    day = dt.datetime(2013, 1, 1)
    path = scratch_path(spark, "copy")
    materialize(spark.createDataFrame([(day + dt.timedelta(days=i), "a") for i in range(40)], "t timestamp_ntz, k string"), path, cluster_by=["t"], partitions=8)
    late = spark.createDataFrame([(day + dt.timedelta(days=39), "a"), (day + dt.timedelta(days=50), "a")], "t timestamp_ntz, k string")
    assert add_arrivals(late, path, ["t"]).count() == 41


def test_totals_of_loads_are_those_of_one_pass(spark):
    draw = random.Random(9)
    values = [0.1, 0.2, -3.75, 1e10, 1e-9, 1.2345678, 1 / 3, math.nan, None, 5e14]
    loads = [[(draw.choice(["a", "b", None]), draw.choice(values[: 3 + 3 * i]), draw.choice(values[:3])) for _ in range(200)] for i in range(3)]
    path = scratch_path(spark, "totals")
    frames = [spark.createDataFrame(rows, "g string, x double, y double") for rows in loads]
    for i, frame in enumerate((*frames, frames[1])):
        add_load(frame, path, str(i % 3 if i < 3 else 1), ["g"], {"sx": "x", "sy": "y"})
    found = kept_totals(spark, path, ["g"], ["sx", "sy"], rows="n")
    whole = frames[0].unionAll(frames[1]).unionAll(frames[2]).repartition(5)
    expected = whole.groupBy("g").agg(F.count(F.lit(1)).alias("n"), total("x").alias("sx"), total("y").alias("sy"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert all(path in file for file in found.inputFiles())


def test_profiles_of_loads_stay_within_their_bounds(spark):
    draw = random.Random(4)
    loads = [[(draw.choice([None, draw.gauss(0, 5), float(i)]), f"k{draw.randint(0, 4000)}" if draw.random() > 0.1 else None) for _ in range(8000)] for i in range(3)]
    path = scratch_path(spark, "profile")
    for i, rows in enumerate((*loads, loads[1])):
        add_load_profile(spark.createDataFrame(rows, "x double, `a.b` string"), path, str(i if i < 3 else 1))
    found = {r["column"]: r for r in kept_profile(spark, path).collect()}
    rows = [row for load in loads for row in load]
    for k, name in enumerate(("x", "a.b")):
        values = [row[k] for row in rows]
        assert (found[name]["rows"], found[name]["nulls"]) == (24_000, values.count(None))
        assert abs(found[name]["distinct"] / len(set(values)) - 1) < 0.05
    numbers = sorted(row[0] for row in rows if row[0] is not None)
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        value, slack = found["x"][name], RANK_ERROR * len(numbers)
        assert sum(n < value for n in numbers) - slack <= share * len(numbers) <= sum(n <= value for n in numbers) + slack
        assert found["a.b"][name] is None


def test_profiles_of_odd_columns(spark):
    path = scratch_path(spark, "profile")
    add_load_profile(spark.createDataFrame([(math.nan, None, 1), (1.0, None, None)], "x double, y double, z int"), path, "a")
    add_load_profile(spark.createDataFrame([], "x double, y double, z int"), path, "b")
    found = {r["column"]: r for r in kept_profile(spark, path).collect()}
    assert found["x"]["p25"] == 1.0 and math.isnan(found["x"]["p75"]) and found["x"]["distinct"] == 2
    assert found["y"]["p50"] is None and found["y"]["distinct"] == 1 and found["z"]["p50"] == 1.0 and found["z"]["nulls"] == 1


def test_rejected_cells_are_reported_once(spark, tmp_path):
    lines = ["n,t,x,s", "1,2013-01-01 00:00:00,1.5,a", "one,2013-01-01 00:00:00,2.5,b", '2,yesterday,"1,5",c', ",,,", "3,2013-01-01 00:00:00", "4,2013-01-01 00:00:00,1,d,e"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    schema = StructType.fromDDL("n int, t timestamp_ntz, x double, s string")
    found = {(r["line"], r["column"], r["value"]) for r in rejected_cells(spark, str(tmp_path), schema).collect()}
    assert found == {
        (lines[2], "n", "one"), (lines[3], "t", "yesterday"), (lines[3], "x", "1,5"), (lines[5], None, None), (lines[6], None, None),
    }
    stored = read_csv(spark, str(tmp_path), schema)
    assert stored.count() == 6 and stored.where("n is null").count() == 2


def test_a_run_that_was_broken_off_goes_on(spark, tmp_path, monkeypatch):
    from tripledger.plans import reports

    fare, trip = fare_table(spark, SF_DIR), trip_table(spark, SF_DIR)
    write_csv(fare.limit(500).toDF(*PADDED_FARE_SCHEMA.fieldNames()), f"{tmp_path}/trip_fare")
    write_csv(trip.limit(500), f"{tmp_path}/trip_data")
    names = list(QUESTIONS)[:6]
    monkeypatch.setattr(reports, "QUESTIONS", {name: QUESTIONS[name] for name in names})
    asked, broken = [], [names[3]]

    def counted(answer, path, **options):
        name = path.rpartition("/")[2]
        asked.append(name)
        if name in broken:
            broken.remove(name)
            (tmp_path / "output" / name).mkdir()
            raise RuntimeError("lost")
        return write_csv(answer, path, **options)

    monkeypatch.setattr(reports, "write_csv", counted)
    with pytest.raises(RuntimeError):
        reports.run(spark, str(tmp_path))
    assert asked == ["fare_profile", *names[:4]]
    kept = {name: sorted(p.name for p in (tmp_path / "output" / name).iterdir()) for name in names[:3]}
    (tmp_path / "trip_fare").rename(tmp_path / "gone")
    asked.clear()
    reports.run(spark, str(tmp_path), resume=True)
    assert asked == names[3:]
    assert kept == {name: sorted(p.name for p in (tmp_path / "output" / name).iterdir()) for name in names[:3]}
    asked.clear()
    reports.run(spark, str(tmp_path), resume=True)
    assert asked == [] and all((tmp_path / "output" / name / "_SUCCESS").exists() for name in names)
