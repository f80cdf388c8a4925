"""Date repair policies D1-D5 and hour-of-day volume (A5)."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.dates import (hourly_volume, hourly_volume_by_policy, read_quarantine,
                                      repair_ancient_dates, split_unparsed, write_quarantine)

ROWS = [(1, dt.datetime(1800, 2, 3, 4, 5, 6)), (2, dt.datetime(1896, 2, 29, 7, 8, 9)),
        (3, dt.datetime(2024, 1, 1)), (4, None)]


def _df(spark, ntz=True):
    df = spark.createDataFrame(ROWS, "id int, d timestamp")
    return df.withColumn("d", F.col("d").cast("timestamp_ntz")) if ntz else df


def _by_id(df):
    return {r["id"]: r["d"] for r in df.collect()}


def test_sentinel_keeps_type_and_nulls(spark):
    out = repair_ancient_dates(_df(spark), ["d"], "sentinel")
    assert dict(out.dtypes)["d"] == "timestamp_ntz"
    got = _by_id(out)
    assert got[1] == got[2] == dt.datetime(1900, 1, 1)
    assert got[3] == dt.datetime(2024, 1, 1) and got[4] is None


def test_null_policy(spark):
    got = _by_id(repair_ancient_dates(_df(spark), ["d"], "null"))
    assert got[1] is None and got[2] is None and got[3] == dt.datetime(2024, 1, 1)


def test_shift_keeps_month_day_time_and_clamps_feb_29(spark):
    got = _by_id(repair_ancient_dates(_df(spark), ["d"], "shift"))
    assert got[1] == dt.datetime(1900, 2, 3, 4, 5, 6)
    assert got[2] == dt.datetime(1900, 2, 28, 7, 8, 9)
    assert got[3] == dt.datetime(2024, 1, 1) and got[4] is None


def test_quarantine_and_drop(spark):
    good, bad = repair_ancient_dates(_df(spark), ["d"], "quarantine")
    assert sorted(r["id"] for r in good.collect()) == [3, 4]
    assert sorted(r["id"] for r in bad.collect()) == [1, 2]
    assert sorted(r["id"] for r in repair_ancient_dates(_df(spark), ["d"], "drop").collect()) == [3, 4]


def test_one_pass_quarantine_table(spark, scratch):
    write_quarantine(_df(spark), ["d"], f"{scratch}/q")
    good, bad = read_quarantine(spark, f"{scratch}/q")
    assert sorted(r["id"] for r in good.collect()) == [3, 4]
    assert sorted(r["id"] for r in bad.collect()) == [1, 2]


TEXT_ROWS = [(1, "01/02/2024"), (2, "abc"), (3, "1850-05-05 10:00:00"), (4, None), (5, "2001-02-03 04:05:06")]
FORMATS = ["yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy"]


def _text(spark):
    return spark.createDataFrame(TEXT_ROWS, "id int, d string")


def test_text_dates_are_parsed_not_compared_as_text(spark):
    good, bad = repair_ancient_dates(_text(spark), ["d"], "quarantine", fmt=FORMATS)
    assert sorted(r["id"] for r in good.collect()) == [1, 4, 5]
    assert {r["id"]: r["d"] for r in bad.collect()} == {2: "abc", 3: "1850-05-05 10:00:00"}
    # with one format, what it does not parse is unparsed, not ancient
    kept = repair_ancient_dates(_text(spark), ["d"], "drop", fmt="MM/dd/yyyy")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4, 5]


def test_unparsed_text_is_kept_by_every_policy(spark):
    want = {"sentinel": dt.datetime(1900, 1, 1), "null": None, "shift": dt.datetime(1900, 5, 5, 10)}
    for policy, repaired in want.items():
        out = repair_ancient_dates(_text(spark), ["d"], policy, fmt=FORMATS)
        good, rejects = split_unparsed(out, ["d"])
        assert good.columns == ["id", "d"]
        assert _by_id(good) == {1: dt.datetime(2024, 1, 2), 3: repaired, 4: None, 5: dt.datetime(2001, 2, 3, 4, 5, 6)}
        assert [(r["id"], r["d"], r["d_unparsed"]) for r in rejects.collect()] == [(2, None, "abc")]
    drop = repair_ancient_dates(_text(spark), ["d"], "drop", fmt=FORMATS)
    assert sorted(r["id"] for r in drop.collect()) == [1, 2, 4, 5]


def test_unknown_policy():
    try:
        repair_ancient_dates(None, ["d"], "fix")
    except ValueError:
        return
    raise AssertionError


def test_hourly_volume_and_policy_histograms(spark):
    df = _df(spark)
    hv = {r["hour"]: r["n"] for r in hourly_volume(df, "d").collect()}
    assert hv == {4: 1, 7: 1, 0: 1, None: 1}
    byp = {(r["policy"], r["hour"]): r["n"] for r in hourly_volume_by_policy(df, "d").collect()}
    assert byp[("sentinel", 0)] == 3  # the sentinel piles ancient rows at midnight
    assert byp[("shift", 4)] == 1 and byp[("shift", 7)] == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1600, 1, 1), max_value=dt.datetime(2100, 1, 1)),
                min_size=1, max_size=20))
def test_properties(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, d timestamp") \
        .withColumn("d", F.col("d").cast("timestamp_ntz"))
    shifted = _by_id(repair_ancient_dates(df, ["d"], "shift"))
    for i, v in enumerate(values):
        s = shifted[i]
        assert (s.month, s.hour, s.minute, s.second) == (v.month, v.hour, v.minute, v.second)
        assert s.day == v.day or (v.month == 2 and v.day == 29 and s.day == 28)
    good, bad = repair_ancient_dates(df, ["d"], "quarantine")
    assert good.count() + bad.count() == len(values)


def test_ancient_report_counts_per_column(spark):
    from tidemark.plans.bronze import ancient_report
    df = _df(spark).withColumn("e", F.col("d"))
    r = ancient_report(df, ["d", "e"]).first()
    assert (r["d"], r["e"], r["any"]) == (2, 2, 2)
