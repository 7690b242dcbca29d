"""Small ride tables full of nulls, ties, repeated keys and fan-out, and helpers to compare results."""

from __future__ import annotations

import datetime as dt
import random

from tripledger.schema import FARE_COLUMNS, FARE_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA

FIRST = dt.datetime(2013, 1, 1)


def moment(rng, null=0.05):
    if rng.random() < null:
        return None
    return FIRST + dt.timedelta(days=rng.randrange(10), seconds=rng.choice([0, 1, 61, 3600, 86399]))


def pick(rng, values, null=0.05):
    return None if rng.random() < null else rng.choice(values)


def fare_rows(seed, n):
    rng = random.Random(seed)
    return [
        {
            "medallion": pick(rng, ["m1", "m2", "m3"]),
            "hack_license": pick(rng, ["h1", "h2", "h3", "h4"]),
            "vendor_id": pick(rng, ["CMT", "VTS", "None"]),
            "pickup_datetime": moment(rng),
            "payment_type": pick(rng, ["CSH", "CRD", "NOC"]),
            "fare_amount": pick(rng, [2.5, 10.0, 52.0, 1000.25]),
            "surcharge": pick(rng, [0.0, 0.5]),
            "mta_tax": 0.5,
            "tip_amount": pick(rng, [0.0, 0.0, 1.5, 2.5, 9.0, 1234.5]),
            "tolls_amount": 0.0,
            "total_amount": pick(rng, [0.0, 3.0, 12.5, 66.75, 10000.0]),
        }
        for _ in range(n)
    ]


def trip_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        pickup = moment(rng)
        dropoff = None
        if pickup and rng.random() > 0.05:
            dropoff = pickup + dt.timedelta(seconds=rng.choice([0, 1, 600, 86400, 200000]))
        rows.append(
            {
                "medallion": pick(rng, ["m1", "m2", "m3"]),
                "hack_license": pick(rng, ["h1", "h2", "h3", "h4"]),
                "vendor_id": pick(rng, ["CMT", "VTS", "None"]),
                "rate_code": pick(rng, [1, 2, 5]),
                "store_and_fwd_flag": pick(rng, ["Y", "N"]),
                "pickup_datetime": pickup,
                "dropoff_datetime": dropoff,
                "passenger_count": pick(rng, [1, 5, 6, 7]),
                "trip_time_in_secs": pick(rng, [0.0, 600.0, 1800.0, 1801.0]),
                "trip_distance": pick(rng, [0.0, 1.25, 9.5, 10.5]),
                "pickup_longitude": None,
                "pickup_latitude": None,
                "dropoff_longitude": None,
                "dropoff_latitude": None,
            }
        )
    return rows


def fare_frame(spark, rows):
    return spark.createDataFrame([tuple(row[c] for c in FARE_COLUMNS) for row in rows], FARE_SCHEMA)


def trip_frame(spark, rows):
    return spark.createDataFrame([tuple(row[c] for c in TRIP_COLUMNS) for row in rows], TRIP_SCHEMA)


def fare(**values):
    return {name: None for name in FARE_COLUMNS} | values


def trip(**values):
    return {name: None for name in TRIP_COLUMNS} | values


def rows_of(df, *columns):
    return [tuple(row) for row in df.select(*(columns or df.columns)).collect()]


def comparable(rows):
    """Rows as a sorted list, floats to 6 digits, nulls first."""
    cells = [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows]
    return sorted(cells, key=lambda row: [(v is not None, str(type(v)), v if v is not None else 0) for v in row])
