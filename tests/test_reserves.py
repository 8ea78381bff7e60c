"""Clamped scans and the year close against plain Python."""

import datetime as dt
import random

import pytest
from obslake.operators import reserves as rs
from obslake.operators.scans import clamped_scan, step
from pyspark.sql import functions as F


def test_clamped_scan_equals_a_plain_loop(spark):
    rnd = random.Random(3)
    maybe = lambda x: None if rnd.random() < 0.2 else x
    rows = []
    for key, n in (("a", 1), (None, 97), ("c", 64)):
        rows += [(key, i, maybe(float(rnd.randint(-30, 30))), maybe(0.0), maybe(float(rnd.randint(20, 60))), 10.0 if i == 0 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, d double, low double, high double, opening double")
    got = clamped_scan(df, ["k"], ["i"], step(F.col("d"), F.col("low"), F.col("high")), F.col("opening"), F.floor(F.col("i") / 8), 8)
    want, now = {}, {}
    for k, i, d, low, high, _ in rows:
        x = before = now.get(k, 10.0)
        x += d or 0.0
        x = x if low is None else max(x, low)
        now[k] = x if high is None else min(x, high)
        want[k, i] = (before, now[k])
    assert {(r["k"], r["i"]): (r["before"], r["after"]) for r in got.collect()} == want
    assert got.columns == [*df.columns, "before", "after"]


def test_more_rows_than_a_bucket_may_hold_are_an_error(spark):
    df = spark.range(9).select(F.lit("k").alias("k"), "id")
    with pytest.raises(ValueError, match="bucket_rows"):
        clamped_scan(df, ["k"], ["id"], step(F.lit(1.0)), F.lit(0.0), F.lit(0), 8)


def months(spark, rows):
    s = "e string, m date, delta double, x double, rate double, v0 double, f0 double"
    return spark.createDataFrame([("a", dt.date(2026, m, 1), *rest) for m, *rest in rows], s)


def test_missing_exposure_leaves_the_fixed_reserve_alone(spark):
    df = months(spark, [(1, 50.0, 1000.0, 0.01, 20.0, 80.0), (2, 5.0, None, 0.01, None, None), (3, None, 1000.0, 0.01, None, None), (6, -100.0, None, None, None, None)])
    got = [r.asDict() for r in rs.reserve_scan(df, "e", "m", "delta", "x", "rate", "v0", "f0").orderBy("m").collect()]
    assert [(r["volatility"], r["fixed"]) for r in got] == [(70.0, 90.0), (75.0, 90.0), (75.0, 100.0), (0.0, 75.0)]
    assert [(r["no_delta"], r["no_exposure"], r["months_skipped"]) for r in got] == [(False, False, 0), (False, True, 0), (True, False, 0), (False, True, 2)]
    last = got[-1]
    assert (last["offset"], last["shortfall"], last["draw"], last["uncovered"], last["cap_hit"]) == (75.0, 25.0, 25.0, 0.0, False)


def test_cap_hit_and_uncovered(spark):
    df = months(spark, [(1, -30.0, 100.0, 0.5, 10.0, 0.0), (2, -500.0, 100.0, 0.5, 0.0, 0.0)])
    got = [r.asDict() for r in rs.reserve_scan(df, "e", "m", "delta", "x", "rate", "v0", "f0").orderBy("m").collect()]
    assert (got[0]["draw"], got[0]["fixed"], got[0]["cap_hit"]) == (20.0, 10.0, True)
    assert (got[1]["draw"], got[1]["fixed"], got[1]["uncovered"]) == (60.0, 0.0, 440.0)


def test_absent_inputs_of_the_delta_and_the_benchmark_are_not_zero(spark):
    df = spark.createDataFrame([(None, "100", 1.0, 1.0), (5.0, "100", None, None), (5.0, "50", None, 0.1)], "g double, c string, p double, d double")
    assert [r[0] for r in df.select(rs.volatility_delta(*[F.col(c) for c in "gcpd"])).collect()] == [None, 5.0, None]
    df = spark.createDataFrame([(100.0, None, 0.4, 0.0, None), (1000.0, 0.6, 0.4, 1.0, None), (1000.0, 0.6, 0.4, None, None)], "m double, b double, c double, f double, k double")
    got = [r[0] for r in df.select(rs.strengthening_reserve(*[F.col(c) for c in "mbcfk"])).collect()]
    assert got[0] is None and got[1] == pytest.approx(4.0) and got[2] is None


def test_the_year_close_hands_the_remainder_on(spark):
    df = months(spark, [(m, 0.0, 1000.0 if m != 3 else None, 0.01, 0.0, 0.0) for m in range(1, 13)])
    scanned = rs.reserve_scan(df, "e", "m", "delta", "x", "rate", "v0", "f0")
    s = "e string, y int, profit double, cap_after_tax double, opening double, after_tax double, mean_denominator double, benchmark double, current_ratio double, capital_raised double"
    years = spark.createDataFrame(
        [("a", 2026, 500.0, 100.0, 0.0, 0.8, 10000.0, 0.9, 0.4, 7.0), ("a", 2027, 500.0, 100.0, None, 0.8, 10000.0, 0.9, 0.4, None), ("b", 2026, None, None, None, None, 1.0, 0.9, 0.1, None)], s
    )
    got = {(r["e"], r["y"]): r.asDict() for r in rs.reserve_chain(scanned, years, "e", "m", "y").collect()}
    # eleven months of 10 added, 88 after tax: 50 covers the special reserve, 38 goes on
    first = got["a", 2026]
    assert [round(first[c], 6) for c in ("deduction", "provision", "left", "due")] == [88.0, 0.0, 38.0, 80.0] and first["months_missing"] == 1
    assert got["a", 2027]["deduction"] is None and got["a", 2027]["provision"] is None and got["a", 2027]["due"] is None
    assert got["b", 2026]["provision"] is None and got["b", 2026]["balance"] == 0.0
