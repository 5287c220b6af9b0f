"""Month-end windows against plain range conditions, with one hot customer."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from tradewind.operators import intervals
from tradewind.plans import retention


def minus_months(ts, n):
    month = ts.month - 1 - n
    year, month = ts.year + month // 12, month % 12 + 1
    last = (dt.datetime(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return ts.replace(year=year, month=month, day=min(ts.day, last))


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(11)
    start = dt.datetime(2017, 1, 1)
    out = []
    for order in range(900):
        person = 0 if order % 3 == 0 else rnd.randrange(1, 120)  # a third by one person
        ts = start + dt.timedelta(seconds=rnd.randrange(600 * 86400))
        if ts.month == 8:  # a month nobody buys in
            continue
        out.append((person, order, ts))
    out.append((7, 5000, dt.datetime(2018, 5, 31, 23, 59, 59)))
    out.append((8, 5001, dt.datetime(2018, 2, 28, 23, 59, 59)))
    out.append((9, 5002, dt.datetime(2018, 3, 1)))
    return out


@pytest.fixture(scope="module")
def delivered(spark, events):
    return spark.createDataFrame(
        events + events[:50],  # some rows twice
        "customer_unique_id int, order_id int, order_purchase_timestamp timestamp_ntz")


def expected_at(events, moment):
    people = defaultdict(set)
    for person, order, ts in events:
        if ts <= moment:
            people[person].add((ts, order))
    out = {"lifetime_repeat_purchase": (
        len(people), sum(len(o) > 1 for o in people.values()))}
    for n in (3, 6):
        lower = minus_months(moment, n)
        inside = {p: sum(ts > lower for ts, _ in o) for p, o in people.items()}
        early = {p for p, o in people.items() if min(o)[0] <= lower}
        here = [p for p, k in inside.items() if k]
        out[f"last_{n}m_returning_customer"] = (len(here), sum(p in early for p in here))
        out[f"last_{n}m_repeat_purchase"] = (len(here), sum(inside[p] > 1 for p in here))
    return out


def month_ends(events):
    ends = {}
    for _, _, ts in events:
        key = ts.date().replace(day=1)
        ends[key] = max(ends.get(key, ts), ts)
    return ends


def test_monthly(events, delivered):
    got = defaultdict(dict)
    for r in retention.monthly(delivered).collect():
        got[r["report_month"]][r["metric_code"]] = (
            r["total_customers"], r["returning_customers"])
    expected = {m: expected_at(events, end) for m, end in month_ends(events).items()}
    assert dict(got) == expected


def test_snapshot(spark, events, delivered):
    moment = max(ts for _, _, ts in events)
    dates = spark.createDataFrame(
        [(moment.date(), moment)], "as_of_date date, as_of_timestamp timestamp_ntz")
    got = {r["metric_code"]: (r["total_customers"], r["returning_customers"])
           for r in retention.snapshot(delivered, dates).collect()}
    assert got == expected_at(events, moment)


@pytest.mark.parametrize("months", [1, 3, 6])
def test_intervals(spark, events, months):
    df = spark.createDataFrame(events, "member int, id int, ts timestamp_ntz")
    inside = {r["report_month"]: (r["rows_in_window"], r["members_in_window"])
              for r in intervals.in_window(df, "ts", "member", months).collect()}
    before = {r["report_month"]: r["members_before"]
              for r in intervals.before_window(df, "ts", "member", months).collect()}
    for month, end in month_ends(events).items():
        lower = minus_months(end, months)
        here = [p for p, _, ts in events if lower < ts <= end]
        assert inside[month] == (len(here), len(set(here)))
        assert before[month] == len({p for p, _, ts in events if ts <= lower})


def test_up_to_month_end(spark, events):
    df = spark.createDataFrame(events, "member int, id int, ts timestamp_ntz")
    got = {r["report_month"]: (r["as_of"], r["rows_before_end"])
           for r in intervals.up_to_month_end(df, "ts").collect()}
    for month, end in month_ends(events).items():
        assert got[month] == (end, sum(ts <= end for _, _, ts in events))
