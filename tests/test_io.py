"""Sources, sinks and the whole run from files to reports."""

from __future__ import annotations

import csv
import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import comparable, fare_frame, fare_rows, rows_of, trip_frame, trip_rows

from tripledger.plans.catalog import QUESTIONS, VARIANTS
from tripledger.plans.reports import read_raw, run
from tripledger.schema import FARE_COLUMNS, FARE_SCHEMA, PADDED_FARE_SCHEMA, TRIP_COLUMNS
from tripledger.sources import materialize, read_csv, read_parquet, write_csv, write_parquet
from tripledger.sources.scratch import scratch_owner, scratch_path


def write_lines(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEADER = ", ".join(FARE_COLUMNS)
GOOD = "m,h,v,2013-01-01 15:11:48,CSH,6.5,0,0.5,0,0,7"


def test_padded_header_and_bad_cells(spark, tmp_path):
    path = write_lines(
        tmp_path / "fare.csv", HEADER, GOOD, "m,h,v,not a time,CSH,six,0,0.5,,0,7", "m, h,v,2013-01-01 00:00:00,CSH,1,0,0,0,0,1"
    )
    df = read_csv(spark, path, PADDED_FARE_SCHEMA)
    assert df.columns[1] == " hack_license"
    good, bad, blank = rows_of(df.toDF(*FARE_COLUMNS))
    assert good == ("m", "h", "v", dt.datetime(2013, 1, 1, 15, 11, 48), "CSH", 6.5, 0.0, 0.5, 0.0, 0.0, 7.0)
    assert bad == ("m", "h", "v", None, "CSH", None, 0.0, 0.5, None, 0.0, 7.0)
    assert blank[1] == " h"


def test_columns_bind_by_position_whatever_the_header(spark, tmp_path):
    path = write_lines(tmp_path / "fare.csv", ",".join(reversed(FARE_COLUMNS)), GOOD)
    row = read_csv(spark, path, FARE_SCHEMA).first()
    assert (row["medallion"], row["total_amount"]) == ("m", 7.0)


def test_without_schema_all_is_text(spark, tmp_path):
    path = write_lines(tmp_path / "x.csv", "a, b", "1,2.5", "3,")
    df = read_csv(spark, path)
    assert df.dtypes == [("a", "string"), (" b", "string")]
    assert rows_of(df) == [("1", "2.5"), ("3", None)]
    assert read_csv(spark, path, header=False).count() == 3


def test_csv_sink_writes_headers_and_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int").repartition(2)
    write_csv(df, path)
    assert {part.read_text().splitlines()[0] for part in Path(path).glob("part-*.csv")} == {"x,y"}
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_csv(df, path)
    write_csv(df, path, mode="overwrite")
    assert comparable(rows_of(read_csv(spark, path))) == [("a", "1"), ("b", "2")]


def test_parquet_round_trip(spark, tmp_path):
    df = fare_frame(spark, fare_rows(1, 50))
    write_parquet(df, str(tmp_path / "fare"))
    assert comparable(rows_of(read_parquet(spark, str(tmp_path / "fare")))) == comparable(rows_of(df))


@pytest.mark.parametrize("order", [(), ("pickup_datetime", "medallion")])
def test_materialize_cleans_once(spark, tmp_path, order):
    rows = fare_rows(6, 60)
    empty = {name: None for name in FARE_COLUMNS}
    df = fare_frame(spark, [*rows, *rows, empty])
    stored = materialize(df, str(tmp_path / "fare"), cluster_by=order)
    distinct = {tuple(row[c] for c in FARE_COLUMNS) for row in rows}
    assert comparable(rows_of(stored)) == comparable(distinct)
    assert stored.schema == df.schema


def test_a_repeated_value_does_not_fill_one_partition(spark, tmp_path):
    """Half of the rows lack the time they are clustered by."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.timestamp_seconds("id")).alias("t"), F.col("id").cast("string").alias("x")
    )
    # Partitions as small as these would otherwise be merged at run time.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cleaned = materialize(df, str(tmp_path / "t"), cluster_by=["t"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in cleaned.where("t is null").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 10_000
    assert max(sizes) < 5_000


def test_scratch_path_is_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master", ["yarn", "local[8]"])
def test_scratch_needs_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")
    context.getCheckpointDir = lambda: "hdfs://shared/checkpoints/"
    assert scratch_path(session, "x").startswith("hdfs://shared/checkpoints/x-")


def test_an_owner_leaves_nothing_behind(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    fare, trip = fare_frame(spark, fare_rows(3, 50)), trip_frame(spark, trip_rows(3, 50))
    with scratch_owner(spark):
        for name in ("rides_with_weekday_revenue", "top_cash_tips"):
            QUESTIONS[name](fare, trip).count()
        VARIANTS["trips_above_mean_tip"](fare, trip).count()
        assert set(shared.iterdir()) > before
    assert set(shared.iterdir()) == before


def test_file_sizes_of_a_copy(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("x"))
    materialize(df, str(tmp_path / "a"), cluster_by=["x"], partitions=4)
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 4
    materialize(df, str(tmp_path / "b"), partitions=2, rows_per_file=100)
    assert len(list((tmp_path / "b").glob("*.parquet"))) in (10, 11)


def test_all_reports_from_raw_files(spark, tmp_path):
    fares, trips = fare_rows(11, 300), trip_rows(12, 300)
    for name, columns, rows in (("trip_fare", FARE_COLUMNS, fares), ("trip_data", TRIP_COLUMNS, trips)):
        (tmp_path / name).mkdir()
        with open(tmp_path / name / "part.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow([columns[0], *[f" {c}" for c in columns[1:]]])
            writer.writerows([[row[c] for c in columns] for row in rows + rows])
    raw_fare, raw_trip = read_raw(spark, str(tmp_path))
    assert (raw_fare.columns, raw_trip.columns) == (FARE_COLUMNS, TRIP_COLUMNS)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    run(spark, str(tmp_path))
    assert set(shared.iterdir()) == before
    output = tmp_path / "output"
    assert {p.name for p in output.iterdir()} == {*QUESTIONS, "fare_profile"}
    unique_fares = list({tuple(r.items()): r for r in fares}.values())
    unique_trips = list({tuple(r.items()): r for r in trips}.values())
    for name in ("revenue_by_vendor", "driver_of_each_day", "rides_by_rate_code"):
        answer = QUESTIONS[name](fare_frame(spark, unique_fares), trip_frame(spark, unique_trips))
        stored = read_csv(spark, str(output / name), answer.schema)
        assert comparable(rows_of(stored)) == comparable(rows_of(answer))
    profiled = {r["column"]: r for r in read_csv(spark, str(output / "fare_profile")).collect()}
    assert profiled["medallion"]["rows"] == str(2 * len(fares))
