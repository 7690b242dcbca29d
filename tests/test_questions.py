"""All questions against straightforward Python over small tables full of nulls, ties and repeats."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import pytest
from samples import comparable, fare, fare_frame, fare_rows, rows_of, trip, trip_frame, trip_rows

from tripledger.plans.catalog import ON_RIDE_TOTALS, QUESTIONS, VARIANTS
from tripledger.plans.rides import ride_totals
from tripledger.schema import FARE_COLUMNS, RIDE_KEYS

ALL = QUESTIONS | VARIANTS


def total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def text(value):
    return None if value is None else f"{value:,.2f}"


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def weekday(moment):
    return None if moment is None else moment.strftime("%A")


def day(moment):
    return None if moment is None else moment.strftime("%Y-%m-%d")


def pairs(fares, trips, keys):
    by_key = grouped(trips, lambda r: tuple(r[k] for k in keys))
    for f in fares:
        key = tuple(f[k] for k in keys)
        if None not in key:
            for t in by_key.get(key, []):
                yield f, t


def best(totals):
    """Largest non-null value per first key part, ties kept. ``totals``: {(group, ...): value}."""
    top = {}
    for key, value in totals.items():
        if value is not None:
            top[key[0]] = max(value, top.get(key[0], value))
    return [(key, value) for key, value in totals.items() if value is not None and value == top[key[0]]]


def desc(value):
    """Sort key for descending order with nulls last, for numbers."""
    return (value is None, -(value or 0))


def asc(value):
    return (value is not None, value if value is not None else "")


def busiest_weekdays(fares, trips):
    known = [t for t in trips if t["vendor_id"] is not None]
    counts = Counter((t["vendor_id"], weekday(t["pickup_datetime"])) for t in known)
    return [(*key, n) for key, n in best(counts)]


def revenue_by_vendor(fares, trips):
    groups = grouped(fares, lambda r: r["vendor_id"])
    return [(v, text(total(r["total_amount"] for r in g))) for v, g in groups.items() if v is not None]


def mean_distance_by_passengers(fares, trips):
    groups = grouped(trips, lambda r: (r["vendor_id"], r["passenger_count"]))
    return [(*k, mean(r["trip_distance"] for r in g)) for k, g in groups.items() if k[1] is not None]


def net_changes(trips):
    net = Counter()
    for t in trips:
        if t["pickup_datetime"] is not None:
            net[t["pickup_datetime"]] += 1
        if t["dropoff_datetime"] is not None:
            net[t["dropoff_datetime"]] -= 1
    return net


def top_days(levels):
    peaks = {d: max(level for _, level in group) for d, group in grouped(levels, lambda e: day(e[0])).items()}
    return sorted(peaks.items(), key=lambda item: (-item[1], item[0]))[:5]


def simultaneous_trips(fares, trips):
    return top_days(net_changes(trips).items())


def peak_concurrency(fares, trips):
    levels, level = [], 0
    for instant, change in sorted(net_changes(trips).items()):
        level += change
        levels.append((instant, level))
    return top_days(levels)


def highest_total_by_vendor(fares, trips):
    groups = grouped(fares, lambda r: r["vendor_id"])
    return [
        (v, max((r["total_amount"] for r in g if r["total_amount"] is not None), default=None))
        for v, g in groups.items()
        if v is not None
    ]


def rides_by_rate_code(fares, trips):
    counts = Counter(t["rate_code"] for _, t in pairs(fares, trips, RIDE_KEYS))
    return [(code, n) for code, n in counts.items() if code is not None]


def trips_above_mean_tip(fares, trips):
    groups = grouped(pairs(fares, trips, RIDE_KEYS), lambda p: p[1]["rate_code"])
    result = []
    for code, group in groups.items():
        tips = [f["tip_amount"] for f, _ in group if f["tip_amount"] is not None]
        above = [tip for tip in tips if tip > mean(tips)]
        if code is not None and above:
            result.append((code, len(above)))
    return result


def weekday_tips(fares):
    groups = grouped(fares, lambda r: (r["vendor_id"], weekday(r["pickup_datetime"])))
    return [(*k, total(r["tip_amount"] for r in g)) for k, g in groups.items()]


def best_tip_weekday(fares, trips):
    rows = [(v, d, text(tips)) for v, d, tips in weekday_tips(fares)]
    ordered = sorted(sorted(rows, key=lambda r: asc(r[1])), key=lambda r: r[2] or "", reverse=True)
    return list({row[0]: row for row in reversed(ordered)}.values())


def best_tip_weekday_numeric(fares, trips):
    ordered = sorted(weekday_tips(fares), key=lambda r: (desc(r[2]), asc(r[1])))
    return [(v, d, text(tips)) for v, d, tips in {row[0]: row for row in reversed(ordered)}.values()]


def mean_fare_by_payment_type(fares, trips):
    return [(k, text(mean(r["fare_amount"] for r in g))) for k, g in grouped(fares, lambda r: r["payment_type"]).items()]


def driver_totals(fares, trips):
    groups = grouped(pairs(fares, trips, ["hack_license", "pickup_datetime"]), lambda p: (p[1]["vendor_id"], p[1]["hack_license"]))
    return [
        (*k, mean(t["trip_distance"] for _, t in g), total(f["tip_amount"] for f, _ in g)) for k, g in groups.items()
    ]


def ranked(rows, order):
    result = []
    for group in grouped(rows, lambda r: r[0]).values():
        for row in group:
            rank = 1 + sum(order(other) > order(row) for other in group)
            if rank <= 10:
                result.append((row[0], row[1], text(row[2]), text(row[3]), rank))
    return result


def top_drivers_by_vendor(fares, trips):
    return ranked(driver_totals(fares, trips), lambda r: (text(r[2]) or "", text(r[3]) or ""))


def top_drivers_by_vendor_numeric(fares, trips):
    def order(row):
        return [(v is not None, v or 0) for v in row[2:]]

    return ranked(driver_totals(fares, trips), order)


def long_trip_share(fares, trips):
    result = []
    for v, g in grouped(trips, lambda r: r["vendor_id"]).items():
        if v not in (None, "None"):
            long = sum(r["trip_time_in_secs"] is not None and r["trip_time_in_secs"] > 1800 for r in g)
            result.append((v, len(g), long, text(long / len(g) * 100)))
    return result


def top_cash_tips(fares, trips):
    result = []
    cash = [r for r in fares if r["payment_type"] == "CSH"]
    for v, group in grouped(cash, lambda r: r["vendor_id"]).items():
        levels = sorted({r["tip_amount"] for r in group}, key=desc)
        ranks = {level: i + 1 for i, level in enumerate(levels)}
        result += [(v, r["tip_amount"], ranks[r["tip_amount"]]) for r in group if ranks[r["tip_amount"]] <= 5]
    return result


def rides_by_day_type(fares, trips):
    def kind(moment):
        return "weekday" if moment is not None and moment.weekday() < 5 else "weekend"

    return [(*k, n) for k, n in Counter((r["vendor_id"], kind(r["pickup_datetime"])) for r in fares).items()]


def tips_above_fare(fares, trips):
    names = [*RIDE_KEYS, "payment_type", "fare_amount", "tip_amount"]
    both = [r for r in fares if r["fare_amount"] is not None and r["tip_amount"] is not None]
    return [tuple(r[n] for n in names) for r in both if r["fare_amount"] < r["tip_amount"]]


def earnings_by_day(fares, trips):
    groups = grouped(fares, lambda r: (r["vendor_id"], day(r["pickup_datetime"])))
    return [
        (*k, total(r["total_amount"] for r in g))
        for k, g in groups.items()
        if k[1] is not None and "2013-01-01" <= k[1] <= "2013-01-07"
    ]


def driver_of_each_day(fares, trips):
    groups = grouped(
        pairs(fares, trips, RIDE_KEYS), lambda p: (day(p[1]["dropoff_datetime"]), p[0]["hack_license"], p[0]["vendor_id"])
    )
    return [(*k, v) for k, v in best({k: total(f["tip_amount"] for f, _ in g) for k, g in groups.items()})]


def fare_per_second_by_vendor(fares, trips):
    result = []
    for v, g in grouped(pairs(fares, trips, RIDE_KEYS), lambda p: p[0]["vendor_id"]).items():
        amount, seconds = total(f["fare_amount"] for f, _ in g), total(t["trip_time_in_secs"] for _, t in g)
        result.append((v, amount / seconds if amount is not None and seconds else None))
    return result


def top_vendor_by_payment_type(fares, trips):
    groups = grouped(fares, lambda r: (r["payment_type"], r["vendor_id"]))
    return [(*k, v) for k, v in best({k: total(r["total_amount"] for r in g) for k, g in groups.items()})]


def top_drivers_by_time(fares, trips):
    groups = grouped(trips, lambda r: (r["vendor_id"], r["hack_license"]))
    rows = [(*k, total(r["trip_time_in_secs"] for r in g)) for k, g in groups.items()]
    return sorted(rows, key=lambda r: (desc(r[2]), asc(r[0]), asc(r[1])))[:5]


def most_popular_payment_type(fares, trips):
    counts = Counter(r["payment_type"] for r in fares)
    return sorted(counts.items(), key=lambda item: (-item[1], asc(item[0])))[:1]


def highest_fare(fares, trips):
    others = [c for c in FARE_COLUMNS if c not in ("fare_amount", "vendor_id")]
    rows = [r for r in fares if r["vendor_id"] == "VTS"]
    rows.sort(key=lambda r: [desc(r["fare_amount"]), *[(r[c] is not None, r[c] or type(r[c])()) if r[c] is not None else (False,) for c in others]])
    return [tuple(r[c] for c in FARE_COLUMNS) for r in rows[:1]]


def top_totals_of_large_parties(fares, trips):
    large = [t for t in trips if t["passenger_count"] is not None and t["passenger_count"] > 5]
    groups = grouped(
        pairs(fares, large, ["medallion", "hack_license", "pickup_datetime"]),
        lambda p: (p[0]["medallion"], p[0]["hack_license"], p[1]["passenger_count"]),
    )
    rows = [
        (*k, max((f["total_amount"] for f, _ in g if f["total_amount"] is not None), default=None))
        for k, g in groups.items()
    ]
    return sorted(rows, key=lambda r: (desc(r[3]), r[:3]))[:10]


def rides_with_weekday_revenue(fares, trips):
    def number(moment):
        return None if moment is None else moment.isoweekday() % 7 + 1

    groups = grouped(fares, lambda r: (number(r["pickup_datetime"]), r["payment_type"]))
    return [
        (*[r[c] for c in FARE_COLUMNS], k[0], total(x["total_amount"] for x in g)) for k, g in groups.items() for r in g
    ]


def tip_percentages(fares, trips):
    kept = [r for r in fares if r["payment_type"] not in (None, "CSH")]
    result = []
    for g in grouped(kept, lambda r: (r["medallion"], r["hack_license"], r["pickup_datetime"])).values():
        tips, whole = total(r["tip_amount"] for r in g), total(r["total_amount"] for r in g)
        share = tips / whole * 100 if tips is not None and whole else None
        result += [(*[r[c] for c in FARE_COLUMNS], share) for r in g]
    return result


def mean_duration_by_rate_code(fares, trips):
    groups = grouped(trips, lambda r: r["rate_code"])
    return [(k, mean(r["trip_time_in_secs"] for r in g)) for k, g in groups.items() if k is not None]


@pytest.fixture(scope="module", params=[1, 2])
def tables(request, spark):
    fares, trips = fare_rows(request.param, 400), trip_rows(request.param + 100, 400)
    return fares, trips, fare_frame(spark, fares).cache(), trip_frame(spark, trips).cache()


@pytest.mark.parametrize("name", sorted(ALL))
def test_matches_plain_python(tables, name):
    fares, trips, fare_df, trip_df = tables
    expected = globals()[name](fares, trips)
    assert expected
    assert comparable(rows_of(ALL[name](fare_df, trip_df))) == comparable(expected)


@pytest.mark.parametrize("name", ON_RIDE_TOTALS)
def test_stored_ride_totals_give_the_same(tables, name):
    fares, trips, fare_df, trip_df = tables
    found = QUESTIONS[name](fare_df, trip_df, totals=ride_totals(fare_df, trip_df))
    assert comparable(rows_of(found)) == comparable(globals()[name](fares, trips))


def test_amounts_are_compared_as_text_or_as_numbers(spark):
    tips = [("a", 1, 9.0), ("a", 2, 1234.5), ("a", 3, 10000.0)]
    df = fare_frame(
        spark,
        [fare(vendor_id=v, pickup_datetime=dt.datetime(2013, 1, d), tip_amount=t) for v, d, t in tips],
    )
    assert rows_of(QUESTIONS["best_tip_weekday"](df, None)) == [("a", "Tuesday", "9.00")]
    assert rows_of(VARIANTS["best_tip_weekday_numeric"](df, None)) == [("a", "Thursday", "10,000.00")]


def test_day_range_includes_both_ends_only(spark):
    moments = [
        dt.datetime(2012, 12, 31, 23, 59, 59, 999999),
        dt.datetime(2013, 1, 1),
        dt.datetime(2013, 1, 7, 23, 59, 59, 999999),
        dt.datetime(2013, 1, 8),
    ]
    df = fare_frame(spark, [fare(vendor_id="a", pickup_datetime=m, total_amount=1.0) for m in moments])
    expected = [("a", "2013-01-01", 1.0), ("a", "2013-01-07", 1.0)]
    assert sorted(rows_of(QUESTIONS["earnings_by_day"](df, None))) == expected
    moved = QUESTIONS["earnings_by_day"](df, None, first=dt.date(2012, 12, 31), last=dt.date(2012, 12, 31))
    assert rows_of(moved) == [("a", "2012-12-31", 1.0)]


def test_zero_denominators_give_null(spark):
    keys = dict(medallion="m", hack_license="h", vendor_id="v", pickup_datetime=dt.datetime(2013, 1, 1))
    fares = fare_frame(spark, [fare(**keys, payment_type="CRD", fare_amount=5.0, tip_amount=1.0, total_amount=0.0)])
    trips = trip_frame(spark, [trip(**keys, trip_time_in_secs=0.0)])
    assert rows_of(QUESTIONS["fare_per_second_by_vendor"](fares, trips)) == [("v", None)]
    assert rows_of(QUESTIONS["tip_percentages"](fares, trips), "tips_percentage") == [(None,)]


def test_one_driver_in_two_vehicles_at_once_fans_out(spark):
    at = dict(hack_license="h", pickup_datetime=dt.datetime(2013, 1, 1))
    fares = fare_frame(spark, [fare(**at, medallion=m, vendor_id="v", tip_amount=t) for m, t in (("m1", 1.0), ("m2", 2.0))])
    trips = trip_frame(spark, [trip(**at, medallion=m, vendor_id="v", trip_distance=d) for m, d in (("m1", 3.0), ("m2", 5.0))])
    assert rows_of(QUESTIONS["top_drivers_by_vendor"](fares, trips)) == [("v", "h", "4.00", "6.00", 1)]


def test_empty_tables(spark):
    fares, trips = fare_frame(spark, []), trip_frame(spark, [])
    for question in ALL.values():
        assert question(fares, trips).count() == 0
