"""From raw CSV files to one CSV directory per question."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tripledger.operators.cleaning import strip_column_names
from tripledger.operators.profiling import profile
from tripledger.plans.catalog import ON_RIDE_TOTALS, QUESTIONS, VARIANTS
from tripledger.plans.rides import ride_totals
from tripledger.schema import PADDED_FARE_SCHEMA, TRIP_SCHEMA
from tripledger.sources import materialize, read_csv, read_parquet, write_csv, write_parquet
from tripledger.sources.scratch import scratch_owner, store

# Where the raw tables lie and the answers go, below the data directory.
FARE_PATH = "trip_fare"
TRIP_PATH = "trip_data"
OUTPUT_PATH = "output"

# Fare columns profiled before cleaning.
PROFILED = ("pickup_datetime", "fare_amount", "surcharge", "medallion", "hack_license")


def read_raw(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw fare and trip tables, with proper column names."""
    fare = strip_column_names(read_csv(spark, f"{data_dir}/{FARE_PATH}", PADDED_FARE_SCHEMA))
    trip = strip_column_names(read_csv(spark, f"{data_dir}/{TRIP_PATH}", TRIP_SCHEMA))
    return fare, trip


def clean_copies(
    fare: DataFrame, trip: DataFrame, clean_dir: str, mode: str = "errorifexists"
) -> tuple[DataFrame, DataFrame]:
    """Cleaned Parquet copies of both tables, in pickup order for day-range filters."""
    return (
        materialize(fare, f"{clean_dir}/fare", mode=mode, cluster_by=["pickup_datetime"]),
        materialize(trip, f"{clean_dir}/trip", mode=mode, cluster_by=["pickup_datetime"]),
    )


def write_answers(
    fare: DataFrame,
    trip: DataFrame,
    output_dir: str,
    names: Iterable[str] | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
    mode: str = "errorifexists",
    resume: bool = False,
) -> None:
    """Answer the named questions (all 24 by default) into one CSV directory each.

    With ``resume``, answers that an earlier call finished stay as they are, and what it left unfinished is
    written anew. A directory is finished when its ``_SUCCESS`` marker is there: the journal of the run.
    """
    known = QUESTIONS | VARIANTS
    for name in names or QUESTIONS:
        if resume and finished(fare.sparkSession, f"{output_dir}/{name}"):
            continue
        if resume:
            mode = "overwrite"
        answer = known[name](fare, trip, **(options or {}).get(name, {}))
        write_csv(answer, f"{output_dir}/{name}", mode=mode)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether Spark has completed a directory."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def run(spark: SparkSession, data_dir: str, clean_dir: str | None = None, mode: str = "errorifexists", resume: bool = False) -> None:
    """Read, profile, clean and answer everything below ``data_dir``.

    The cleaned copies go to ``clean_dir`` (default: ``<data_dir>/clean``), which every executor must
    reach, as it must reach ``data_dir``. With ``resume``, a run that was broken off is continued: what it
    finished, clean copies included, is neither read from the raw files nor asked again.
    """
    output_dir = f"{data_dir}/{OUTPUT_PATH}"
    clean_dir = clean_dir or f"{data_dir}/clean"
    if resume:
        mode = "overwrite"
    copies = [f"{clean_dir}/{name}" for name in ("fare", "trip")]
    done = [finished(spark, path) for path in (f"{output_dir}/fare_profile", *copies)] if resume else [False]
    if not all(done):
        with scratch_owner(spark):
            # Each CSV file is parsed once, into a copy that the profile and the cleaning read.
            raw_fare, raw_trip = (store(df, "raw") for df in read_raw(spark, data_dir))
            write_csv(profile(raw_fare, PROFILED), f"{output_dir}/fare_profile", mode=mode)
            clean_copies(raw_fare, raw_trip, clean_dir, mode=mode)
    fare, trip = (read_parquet(spark, path) for path in copies)
    # Three questions share the join on the ride keys: it is made once.
    if not (resume and all(done) and finished(spark, f"{clean_dir}/ride_totals")):
        write_parquet(ride_totals(fare, trip), f"{clean_dir}/ride_totals", mode=mode)
    totals = read_parquet(spark, f"{clean_dir}/ride_totals")
    options = {name: {"totals": totals} for name in ON_RIDE_TOTALS}
    with scratch_owner(spark):
        write_answers(fare, trip, output_dir, options=options, mode=mode, resume=resume)
