"""DuckDB SQL for every registered query, written in the plainest form (windows over whole groups,
joins of whole tables), independent of how the Spark side computes the same result."""

from __future__ import annotations

_SECOND_OF_DAY = "cast((l_orderkey * 7919 + l_linenumber * 613) % 86400 as bigint)"

FARE = f"""
fare AS (
  SELECT *, round(fare_amount + surcharge + mta_tax + tip_amount + tolls_amount, 2) AS total_amount
  FROM (
    SELECT cast(l_partkey AS varchar) AS medallion,
           cast(l_suppkey AS varchar) AS hack_license,
           CASE l_returnflag WHEN 'A' THEN 'CMT' WHEN 'N' THEN 'VTS' ELSE 'DDS' END AS vendor_id,
           l_shipdate + to_seconds({_SECOND_OF_DAY}) AS pickup_datetime,
           CASE l_orderkey % 5 WHEN 0 THEN 'CSH' WHEN 1 THEN 'CRD' WHEN 2 THEN 'NOC' WHEN 3 THEN 'DIS'
                ELSE 'UNK' END AS payment_type,
           l_extendedprice AS fare_amount,
           round(l_tax * 100) AS surcharge,
           0.5::double AS mta_tax,
           (l_quantity * round(l_discount * 100) * 1000 + (l_orderkey * 31 + l_linenumber * 7) % 100) / 100 AS tip_amount,
           0.0::double AS tolls_amount
    FROM lineitem)
)"""

TRIP = f"""
trip AS (
  SELECT cast(l_partkey AS varchar) AS medallion,
         cast(l_suppkey AS varchar) AS hack_license,
         CASE l_returnflag WHEN 'A' THEN 'CMT' WHEN 'N' THEN 'VTS' ELSE 'DDS' END AS vendor_id,
         l_linenumber AS rate_code,
         'N' AS store_and_fwd_flag,
         l_shipdate + to_seconds({_SECOND_OF_DAY}) AS pickup_datetime,
         l_shipdate + to_seconds({_SECOND_OF_DAY}) + to_seconds(cast(l_quantity * 60 AS bigint)) AS dropoff_datetime,
         cast(l_partkey % 6 + 1 AS integer) AS passenger_count,
         l_quantity * 60 AS trip_time_in_secs,
         l_quantity * 0.25::double AS trip_distance,
         NULL::double AS pickup_longitude,
         NULL::double AS pickup_latitude,
         NULL::double AS dropoff_longitude,
         NULL::double AS dropoff_latitude
  FROM lineitem
)"""

RIDES = """
rides AS (
  SELECT * FROM fare JOIN trip USING (medallion, hack_license, vendor_id, pickup_datetime)
)"""

_FARE_COLUMNS = (
    "medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, surcharge, mta_tax, "
    "tip_amount, tolls_amount, total_amount"
)
_TRIP_COLUMNS = (
    "medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, dropoff_datetime, "
    "passenger_count, trip_time_in_secs, trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, "
    "dropoff_latitude"
)

# Lines with some or all of their keys blanked, for the cleaning rules and null rows.
SPARSE = """
sparse AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS order_key,
         CASE WHEN l_linenumber NOT IN (3, 7) THEN l_linenumber END AS line_number
  FROM lineitem
)"""


def _exact(column: str) -> str:
    """A sum of cents that no order of addition can change."""
    return f"cast(sum(cast({column} AS decimal(18, 2))) AS double)"


def _on_fare(sql: str) -> str:
    return f"WITH {FARE} {sql}"


def _on_trip(sql: str) -> str:
    return f"WITH {TRIP} {sql}"


def _on_rides(sql: str) -> str:
    return f"WITH {FARE}, {TRIP}, {RIDES} {sql}"


def _on_both(sql: str) -> str:
    return f"WITH {FARE}, {TRIP} {sql}"


def _round(digits: int, expression: str, name: str) -> str:
    return f"round({expression}, {digits}) AS {name}"


_MILEAGE = f"{_exact('t.trip_distance')} / count(t.trip_distance)"
_DRIVERS = f"""
  SELECT t.vendor_id AS vendor, t.hack_license,
         {_MILEAGE} AS mileage, {_exact('f.tip_amount')} AS tips,
         format('{{:,.2f}}', {_MILEAGE}) AS average_mileage,
         format('{{:,.2f}}', {_exact('f.tip_amount')}) AS total_tip_amount
  FROM trip t JOIN fare f ON t.hack_license = f.hack_license AND t.pickup_datetime = f.pickup_datetime
  GROUP BY t.vendor_id, t.hack_license
"""

_WEEKDAY_TIPS = f"""
  SELECT vendor_id, dayname(pickup_datetime) AS day_of_week, {_exact('tip_amount')} AS tips,
         format('{{:,.2f}}', {_exact('tip_amount')}) AS total_tips
  FROM fare GROUP BY 1, 2
"""

_EVENTS = """
  SELECT pickup_datetime AS instant, 1 AS step FROM trip WHERE pickup_datetime IS NOT NULL
  UNION ALL
  SELECT dropoff_datetime, -1 FROM trip WHERE dropoff_datetime IS NOT NULL
"""


def _profile(table: str, columns: dict[str, str]) -> str:
    rows = []
    for name, kind in columns.items():
        number = kind in ("double", "int")
        text = f"strftime({{}}({name}), '%Y-%m-%d %H:%M:%S')" if kind == "timestamp_ntz" else f"cast({{}}({name}) AS varchar)"
        rows.append(
            f"""SELECT '{name}' AS "column", '{kind}' AS type, count(*) AS rows,
                count(*) - count({name}) AS nulls,
                count(DISTINCT {name}) + (CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END) AS "distinct",
                {text.format('min')} AS min, {text.format('max')} AS max,
                {f'round(avg({name}), 4)' if number else 'NULL::double'} AS mean,
                {f'round(stddev_samp({name}), 4)' if number else 'NULL::double'} AS stddev
            FROM {table}"""
        )
    return " UNION ALL ".join(rows)


FARE_KINDS = {
    "medallion": "string",
    "hack_license": "string",
    "vendor_id": "string",
    "pickup_datetime": "timestamp_ntz",
    "payment_type": "string",
    "fare_amount": "double",
    "surcharge": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
}
TRIP_KINDS = {
    "medallion": "string",
    "hack_license": "string",
    "vendor_id": "string",
    "rate_code": "int",
    "store_and_fwd_flag": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_time_in_secs": "double",
    "trip_distance": "double",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
}

QUARTILE_COLUMNS = [name for name, kind in FARE_KINDS.items() if kind == "double"]


def _quartiles(table: str, columns: list[str]) -> str:
    parts = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", """
        + ", ".join(f"quantile_disc({name}, {share}) AS {label}" for label, share in parts.items())
        + f" FROM {table}"
        for name in columns
    )


ORACLE: dict[str, str] = {
    # Questions.
    "busiest_weekdays": _on_trip("""
        , counts AS (
          SELECT vendor_id, dayname(pickup_datetime) AS dayofweek, count(*) AS count
          FROM trip WHERE vendor_id IS NOT NULL GROUP BY 1, 2)
        SELECT vendor_id, dayofweek, count
        FROM (SELECT *, max(count) OVER (PARTITION BY vendor_id) AS most FROM counts)
        WHERE count = most"""),
    "revenue_by_vendor": _on_fare(f"""
        SELECT vendor_id, format('{{:,.2f}}', {_exact('total_amount')}) AS total_revenue
        FROM fare WHERE vendor_id IS NOT NULL GROUP BY vendor_id"""),
    "mean_distance_by_passengers": _on_trip(f"""
        SELECT vendor_id, passenger_count, {_round(6, 'avg(trip_distance)', 'avg_trip_distance')}
        FROM trip WHERE passenger_count IS NOT NULL GROUP BY vendor_id, passenger_count"""),
    "simultaneous_trips": _on_trip(f"""
        , events AS ({_EVENTS}),
        summed AS (SELECT instant, sum(step) OVER (PARTITION BY instant ORDER BY instant) AS level FROM events)
        SELECT strftime(instant, '%Y-%m-%d') AS day, cast(max(level) AS bigint) AS simultaneous_trips
        FROM summed GROUP BY 1
        ORDER BY simultaneous_trips DESC NULLS LAST, day ASC NULLS FIRST LIMIT 5"""),
    "highest_total_by_vendor": _on_fare("""
        SELECT vendor_id, round(max(total_amount), 2) AS total_amount
        FROM fare WHERE vendor_id IS NOT NULL GROUP BY vendor_id"""),
    "rides_by_rate_code": _on_rides("""
        , means AS (SELECT rate_code, avg(tip_amount) AS mean_tip FROM rides GROUP BY rate_code)
        SELECT rate_code, count(*) AS trip_count FROM rides JOIN means USING (rate_code) GROUP BY rate_code"""),
    "best_tip_weekday": _on_fare(f"""
        , tips AS ({_WEEKDAY_TIPS})
        SELECT vendor_id, day_of_week, total_tips
        FROM (SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY total_tips DESC NULLS LAST,
                                           day_of_week ASC NULLS FIRST) AS place FROM tips)
        WHERE place = 1"""),
    "mean_fare_by_payment_type": _on_fare(f"""
        SELECT payment_type, format('{{:,.2f}}', {_exact('fare_amount')} / count(fare_amount)) AS average_fare_amount
        FROM fare GROUP BY payment_type"""),
    "top_drivers_by_vendor": _on_both(f"""
        , drivers AS ({_DRIVERS})
        SELECT vendor, hack_license, average_mileage, total_tip_amount, rank
        FROM (SELECT *, cast(rank() OVER (PARTITION BY vendor ORDER BY average_mileage DESC NULLS LAST,
                             total_tip_amount DESC NULLS LAST) AS integer) AS rank FROM drivers)
        WHERE rank <= 10"""),
    "long_trip_share": _on_trip("""
        , counts AS (
          SELECT vendor_id, count(*) AS total_trips,
                 count(CASE WHEN trip_time_in_secs > 1800 THEN 1 END) AS long_trips
          FROM trip WHERE vendor_id <> 'None' GROUP BY vendor_id)
        SELECT vendor_id, total_trips, long_trips,
               format('{:,.2f}', long_trips::double / total_trips::double * 100) AS percentage_long_trips
        FROM counts"""),
    "top_cash_tips": _on_fare("""
        SELECT vendor_id, tip_amount, rank
        FROM (SELECT vendor_id, tip_amount,
                     cast(dense_rank() OVER (PARTITION BY vendor_id ORDER BY tip_amount DESC NULLS LAST)
                          AS integer) AS rank
              FROM fare WHERE payment_type = 'CSH')
        WHERE rank <= 5"""),
    "rides_by_day_type": _on_fare("""
        SELECT vendor_id,
               CASE WHEN dayofweek(pickup_datetime) + 1 IN (2, 3, 4, 5, 6) THEN 'weekday' ELSE 'weekend' END
                 AS day_type,
               count(*) AS count
        FROM fare GROUP BY 1, 2"""),
    "tips_above_fare": _on_fare("""
        SELECT medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, tip_amount
        FROM fare WHERE fare_amount < tip_amount"""),
    "earnings_by_day": _on_fare(f"""
        SELECT vendor_id, strftime(pickup_datetime, '%Y-%m-%d') AS date,
               {_round(2, _exact('total_amount'), 'total_earnings')}
        FROM fare
        WHERE strftime(pickup_datetime, '%Y-%m-%d') BETWEEN '1998-01-01' AND '1998-01-07'
        GROUP BY 1, 2"""),
    "driver_of_each_day": _on_rides(f"""
        , tips AS (
          SELECT vendor_id, hack_license, strftime(dropoff_datetime, '%Y-%m-%d') AS date, {_exact('tip_amount')} AS tips_sum
          FROM rides GROUP BY 1, 2, 3)
        SELECT date, hack_license, vendor_id, {_round(2, 'tips_sum', 'tips_sum')}
        FROM (SELECT *, max(tips_sum) OVER (PARTITION BY date) AS most FROM tips)
        WHERE tips_sum = most"""),
    "fare_per_second_by_vendor": _on_rides(f"""
        SELECT vendor_id,
               {_round(6, 'cast(sum(cast(fare_amount AS decimal(18, 2))) AS double) / nullif(sum(trip_time_in_secs), 0)', 'average_fare_per_second')}
        FROM rides GROUP BY vendor_id"""),
    "top_vendor_by_payment_type": _on_fare(f"""
        , revenue AS (
          SELECT vendor_id, payment_type, {_exact('total_amount')} AS sum_total_amount FROM fare GROUP BY 1, 2)
        SELECT payment_type, vendor_id, {_round(2, 'sum_total_amount', 'sum_total_amount')}
        FROM (SELECT *, max(sum_total_amount) OVER (PARTITION BY payment_type) AS most FROM revenue)
        WHERE sum_total_amount = most"""),
    "top_drivers_by_time": _on_trip(f"""
        SELECT vendor_id, hack_license, {_round(2, 'sum(trip_time_in_secs)', 'sum_trip_time_in_secs')}
        FROM trip GROUP BY vendor_id, hack_license
        ORDER BY sum(trip_time_in_secs) DESC NULLS LAST, vendor_id ASC NULLS FIRST, hack_license ASC NULLS FIRST
        LIMIT 5"""),
    "most_popular_payment_type": _on_fare("""
        SELECT payment_type, count(*) AS count FROM fare GROUP BY payment_type
        ORDER BY count(*) DESC, payment_type ASC NULLS FIRST LIMIT 1"""),
    "highest_fare": _on_fare(f"""
        SELECT {_FARE_COLUMNS} FROM fare WHERE vendor_id = 'VTS'
        ORDER BY fare_amount DESC NULLS LAST, medallion, hack_license, pickup_datetime LIMIT 1"""),
    "top_totals_of_large_parties": _on_both(f"""
        SELECT f.medallion, f.hack_license, passenger_count, {_round(2, 'max(total_amount)', 'max_total_amount')}
        FROM fare f JOIN trip t ON f.medallion = t.medallion AND f.hack_license = t.hack_license
             AND f.pickup_datetime = t.pickup_datetime
        WHERE passenger_count > 5
        GROUP BY f.medallion, f.hack_license, passenger_count
        ORDER BY max(total_amount) DESC NULLS LAST, f.medallion, f.hack_license, passenger_count LIMIT 10"""),
    "rides_with_weekday_revenue": _on_fare(f"""
        SELECT {_FARE_COLUMNS}, cast(dayofweek(pickup_datetime) + 1 AS integer) AS day_num,
               round(cast(sum(cast(total_amount AS decimal(18, 2)))
                          OVER (PARTITION BY dayofweek(pickup_datetime), payment_type) AS double), 2)
                 AS total_revenue_per_day
        FROM fare"""),
    "tip_percentages": _on_fare(f"""
        SELECT {_FARE_COLUMNS},
               round(cast(sum(cast(tip_amount AS decimal(18, 2))) OVER ride AS double)
                     / nullif(cast(sum(cast(total_amount AS decimal(18, 2))) OVER ride AS double), 0) * 100, 6) AS tips_percentage
        FROM fare WHERE payment_type <> 'CSH'
        WINDOW ride AS (PARTITION BY medallion, hack_license, pickup_datetime)"""),
    "mean_duration_by_rate_code": _on_trip(f"""
        SELECT rate_code, {_round(6, 'avg(trip_time_in_secs)', 'avg_trip_duration')}
        FROM trip WHERE rate_code IS NOT NULL GROUP BY rate_code"""),
    # Variants.
    "peak_concurrency": _on_trip(f"""
        , events AS ({_EVENTS}),
        running AS (SELECT instant, sum(step) OVER (ORDER BY instant) AS level FROM events)
        SELECT strftime(instant, '%Y-%m-%d') AS day, cast(max(level) AS bigint) AS simultaneous_trips
        FROM running GROUP BY 1
        ORDER BY simultaneous_trips DESC NULLS LAST, day ASC NULLS FIRST LIMIT 5"""),
    "trips_above_mean_tip": _on_rides("""
        , cents AS (SELECT rate_code, cast(tip_amount AS decimal(18, 2)) AS tip FROM rides),
        marked AS (
          SELECT rate_code, tip * count(tip) OVER (PARTITION BY rate_code) > sum(tip) OVER (PARTITION BY rate_code) AS above
          FROM cents)
        SELECT rate_code, count(*) AS trip_count FROM marked WHERE above AND rate_code IS NOT NULL
        GROUP BY rate_code"""),
    "best_tip_weekday_numeric": _on_fare(f"""
        , tips AS ({_WEEKDAY_TIPS})
        SELECT vendor_id, day_of_week, total_tips
        FROM (SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY tips DESC NULLS LAST,
                                           day_of_week ASC NULLS FIRST) AS place FROM tips)
        WHERE place = 1"""),
    "top_drivers_by_vendor_numeric": _on_both(f"""
        , drivers AS ({_DRIVERS})
        SELECT vendor, hack_license, average_mileage, total_tip_amount, rank
        FROM (SELECT *, cast(rank() OVER (PARTITION BY vendor ORDER BY mileage DESC NULLS LAST,
                             tips DESC NULLS LAST) AS integer) AS rank FROM drivers)
        WHERE rank <= 10"""),
    # Operators below the questions.
    "matched_rides": _on_rides(f"""
        SELECT {_FARE_COLUMNS}, rate_code, store_and_fwd_flag, dropoff_datetime, passenger_count,
               trip_time_in_secs, trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude,
               dropoff_latitude
        FROM rides"""),
    "clean_fare": _on_fare(f"SELECT DISTINCT {_FARE_COLUMNS} FROM fare"),
    "clean_trip": _on_trip(f"SELECT DISTINCT {_TRIP_COLUMNS} FROM trip"),
    "clean_sparse_all": f"""
        WITH {SPARSE} SELECT DISTINCT * FROM sparse WHERE order_key IS NOT NULL OR line_number IS NOT NULL""",
    "clean_sparse_any": f"""
        WITH {SPARSE} SELECT DISTINCT * FROM sparse WHERE order_key IS NOT NULL AND line_number IS NOT NULL""",
    "null_rows": f"WITH {SPARSE} SELECT * FROM sparse WHERE line_number IS NULL",
    "odd_totals": """
        SELECT l_linenumber, l_returnflag, printf('%.9e', sum(CASE
            WHEN l_linenumber = 1 THEN l_extendedprice
            WHEN l_linenumber = 2 THEN l_extendedprice / 7
            WHEN l_linenumber = 3 THEN l_extendedprice * 1e9
            WHEN l_linenumber = 4 THEN l_extendedprice * 1e-9
            WHEN l_linenumber = 5 THEN CASE WHEN l_orderkey % 50 = 0 THEN 'nan'::DOUBLE ELSE l_extendedprice END
            WHEN l_linenumber = 6 THEN CASE WHEN l_orderkey % 50 = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice END
            WHEN l_orderkey % 50 = 0 THEN l_extendedprice END))::DOUBLE AS amount
        FROM lineitem GROUP BY 1, 2""",
    "payment_type_counts": _on_fare("SELECT payment_type, count(*) AS count FROM fare GROUP BY payment_type"),
    "sparse_counts": f"WITH {SPARSE} SELECT line_number, count(*) AS count FROM sparse GROUP BY line_number",
    "fare_profile": _on_fare(_profile("fare", FARE_KINDS)),
    "trip_profile": _on_trip(_profile("trip", TRIP_KINDS)),
    "fare_quartiles": _on_fare(_quartiles("fare", QUARTILE_COLUMNS)),
    "csv_with_schema": _on_fare(f"SELECT {_FARE_COLUMNS} FROM fare"),
    "csv_trip_with_schema": _on_trip(f"SELECT {_TRIP_COLUMNS} FROM trip"),
    "csv_without_schema": _on_trip("""
        SELECT medallion, hack_license, vendor_id, cast(rate_code AS varchar) AS rate_code, store_and_fwd_flag,
               strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.000') AS pickup_datetime,
               strftime(dropoff_datetime, '%Y-%m-%dT%H:%M:%S.000') AS dropoff_datetime,
               cast(passenger_count AS varchar) AS passenger_count,
               cast(trip_time_in_secs AS varchar) AS trip_time_in_secs, cast(trip_distance AS varchar) AS trip_distance,
               cast(pickup_longitude AS varchar) AS pickup_longitude, cast(pickup_latitude AS varchar) AS pickup_latitude,
               cast(dropoff_longitude AS varchar) AS dropoff_longitude,
               cast(dropoff_latitude AS varchar) AS dropoff_latitude
        FROM trip"""),
    "parquet_clean_copy": _on_trip(f"SELECT DISTINCT {_TRIP_COLUMNS} FROM trip"),
}

# The same answers, of tables that are kept in another way.
ORACLE |= {
    "co_located_driver_of_each_day": ORACLE["driver_of_each_day"],
    "arrivals_clean_trip": ORACLE["clean_trip"],
    "kept_revenue_by_vendor": ORACLE["revenue_by_vendor"],
    "kept_profile": _on_fare("""
        SELECT 'fare_amount' AS "column", count(*) AS rows, count(*) - count(fare_amount) AS nulls, true AS distinct_near, true AS quartiles_near FROM fare
        UNION ALL SELECT 'tip_amount', count(*), count(*) - count(tip_amount), true, true FROM fare
        UNION ALL SELECT 'medallion', count(*), count(*) - count(medallion), true, true FROM fare"""),
    "csv_rejected_cells": """
        SELECT 'part_key' AS "column", 'no. ' || l_partkey AS value, count(*) AS n FROM lineitem WHERE l_linenumber = 7 GROUP BY 2
        UNION ALL SELECT 'due', 'tomorrow', count(*) FROM lineitem WHERE l_linenumber > 5 AND l_orderkey % 3 = 0""",
}
