import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from obslake.functions.numbers import MONEY
from obslake.operators import aggregates, containment, flows, indicators as ind, joins, quality, reserves, vintages as vt
from obslake.operators.ordered import asof_join, carry_last
from obslake.operators.reconcile import Check, reconcile, run_gate
from obslake.sources import append
from obslake.sources.landed import status_expected


def d(s):
    return dt.date.fromisoformat(s)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: [(x is None, str(x)) for x in r])


# ------------------------------------------------------------- vintages


def store(spark):
    return spark.createDataFrame(
        [
            (d("2026-02-01"), "release", d("2026-03-31"), 625900.0),
            (d("2026-02-01"), "release", d("2026-04-28"), 627700.0),
            (d("2026-02-01"), "briefing", d("2026-03-31"), 625000.0),
            (d("2026-03-01"), "release", d("2026-04-28"), 621400.0),
        ],
        "m date, channel string, vintage date, v double",
    )


def test_latest_and_asof_vintage(spark):
    keys = ["m", "channel"]
    latest = vt.latest_vintage(store(spark), keys, "vintage")
    assert (d("2026-02-01"), "release", 627700.0) in rows(latest, "m", "channel", "v")
    assert latest.count() == 3
    early = vt.asof_vintage(store(spark), keys, "vintage", F.lit(d("2026-04-01")))
    assert rows(early, "m", "channel", "v") == [
        (d("2026-02-01"), "briefing", 625000.0), (d("2026-02-01"), "release", 625900.0)
    ]
    final = vt.asof_vintage(store(spark), keys, "vintage", F.lit(d("2030-01-01")))
    assert rows(final, *final.columns) == rows(latest, *latest.columns)


def test_revision_history(spark):
    r = vt.revisions(store(spark), ["m", "channel"], "vintage", "v").filter("revision_no = 2").collect()
    assert [(x["previous_value"], x["revision"]) for x in r] == [(625900.0, 1800.0)]


def test_channel_priority(spark):
    latest = vt.latest_vintage(store(spark), ["m", "channel"], "vintage")
    picked = vt.pick_by_priority(latest, ["m"], "channel", ["briefing", "release"])
    assert rows(picked, "m", "channel") == [(d("2026-02-01"), "briefing"), (d("2026-03-01"), "release")]
    assert vt.pick_by_priority(latest, ["m"], "channel", ["other"]).count() == 0


def test_last_write_wins(spark):
    df = spark.createDataFrame([("m", "f", 0, 1.0), ("m", "f", 1, 2.0), ("m", "g", 0, 3.0)], "k string, field string, pos int, v double")
    assert rows(vt.last_write_wins(df, ["k"], "field", "pos", "v"), "field", "v") == [("f", 2.0), ("g", 3.0)]


def test_basis_segments(spark):
    df = spark.createDataFrame(
        [("e", d(f"2025-{i:02d}-01"), b) for i, b in enumerate(["IFRS4", "IFRS4", "IFRS17", "IFRS17", None, "IFRS17"], 1)],
        "k string, m date, basis string",
    )
    got = rows(vt.basis_segments(df, ["k"], "m", "basis"), "m", "segment", "is_break")
    assert [x[1] for x in got] == [1, 1, 2, 2, 3, 4]
    assert [x[2] for x in got] == [0, 0, 1, 0, 1, 1]


def test_rows_set_aside_are_counted(spark):
    again = store(spark).withColumn("arrived", F.lit(1)).unionByName(
        store(spark).filter("v = 627700").withColumn("v", F.col("v") + 100).withColumn("arrived", F.lit(2))
    )
    r = vt.revisions(again, ["m", "channel"], "vintage", "v", arrival="arrived").filter("revision_no = 2").collect()
    assert [(x["v"], x["revision"]) for x in r] == [(627700.0, 1800.0)]
    left = vt.set_aside(again, ["m", "channel", "vintage"])
    assert rows(left, *left.columns) == [(d("2026-02-01"), "release", d("2026-04-28"), 1)]


def test_channels_compare_first_arrivals(spark):
    kinds = "k string, v double, arrived int"
    a = spark.createDataFrame([("x", 1.0, 1), ("x", 9.0, 2), ("x", 4.0, None), ("y", None, 1), ("y", 5.0, 2)], kinds)
    b = spark.createDataFrame([("x", 1.0, 3), (None, 2.0, 1)], kinds)
    got = joins.compare_channels(a, b, ["k"], "v", 0.01, arrival="arrived")
    assert rows(got, "k", "value_a", "value_b", "n_set_aside", "agrees") == [
        ("x", 1.0, 1.0, 2, True), ("y", 5.0, None, 0, None), (None, None, 2.0, 0, None)
    ]


# ------------------------------------------------------------- appends


def test_insert_ignore_is_idempotent_and_null_safe(spark):
    schema = "entity string, m date, v double, seq int"
    target = spark.createDataFrame([(None, d("2026-01-01"), 1.0, 0)], schema)
    batch = spark.createDataFrame(
        [(None, d("2026-01-01"), 9.0, 1), (None, d("2026-02-01"), 2.0, 2), (None, d("2026-02-01"), 3.0, 3), ("a", d("2026-01-01"), 4.0, 4)],
        schema,
    )
    for part in (None, "m"):
        once = append.insert_ignore(batch, target, ["entity", "m"], ["seq"], part)
        assert rows(once, "entity", "m", "v") == rows(
            spark.createDataFrame([(None, d("2026-01-01"), 1.0), (None, d("2026-02-01"), 2.0), ("a", d("2026-01-01"), 4.0)], "entity string, m date, v double"),
            "entity", "m", "v",
        )
        twice = append.insert_ignore(batch, once, ["entity", "m"], ["seq"], part)
        assert rows(twice, *twice.columns) == rows(once, *once.columns)


def test_run_log_keeps_fail_then_ok(spark):
    s = spark.createDataFrame([("u", "d", 1, False), ("u", "d", 2, True)], "url string, doc string, attempt int, good boolean")
    st = append.source_status(s, "url", "doc", F.col("good"), F.lit("status 500"), "attempt")
    gate = spark.createDataFrame([("ok", 3)], "status string, checks_total int")
    checks = spark.createDataFrame([("c", m, True) for m in ("2026-01", "2026-02")], "check_name string, obs_month string, passed boolean")
    frames = append.run_log_frames("r1", "stage", gate, st, checks)
    target = frames["run_source_status"].limit(0)
    kept = append.insert_ignore(frames["run_source_status"], target, append.RUN_KEYS["run_source_status"], ["attempt"])
    assert rows(kept, "attempt", "ok", "note") == [(1, False, "status 500"), (2, True, None)]
    logged = frames["run_reconciliation"]
    for _ in range(2):  # both months of one check are kept, and a second append adds nothing
        logged = append.insert_ignore(frames["run_reconciliation"], logged.limit(0) if _ == 0 else logged, append.RUN_KEYS["run_reconciliation"], ["check_name"])
    assert rows(logged, "obs_month") == [("2026-01",), ("2026-02",)]
    assert frames["run_log"].first()["notes"] == '{"status":"ok","checks_total":3}'


def test_duplicate_keys_null_safe(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "e string, m int")
    assert rows(quality.duplicate_keys(df, ["e", "m"]), "e", "n_rows") == [(None, 2)]


# ------------------------------------------------------------- flows


def series(spark, pairs, key="e"):
    return spark.createDataFrame([(key, d(m), D(v)) for m, v in pairs], "e string, m date, v decimal(20,4)")


def test_ytd_with_missing_month(spark):
    df = series(spark, [("2025-01-01", 10), ("2025-02-01", 25), ("2025-04-01", 60), ("2026-01-01", 7)])
    got = rows(flows.ytd_to_flow(df, ["e"], "m", "v"), "m", "flow", "months_covered")
    assert [x[1] for x in got] == [D(10), D(15), None, D(7)]
    assert [x[2] for x in got] == [1, 1, 2, 1]


def test_flow_ytd_round_trip(spark):
    df = series(spark, [(f"{y}-{m:02d}-01", y % 7 * 10 + m) for y in (2024, 2025) for m in range(1, 13)])
    ytd = flows.flow_to_ytd(df, ["e"], "m", "v", MONEY)
    back = flows.ytd_to_flow(ytd.drop("v"), ["e"], "m", "ytd")
    assert rows(back, "m", "flow") == rows(df, "m", "v")


def test_rolling_window_ignores_stretching_gaps(spark):
    df = series(spark, [("2025-01-01", 1), ("2025-02-01", 2), ("2025-06-01", 4), ("2025-07-01", 8)])
    got = rows(flows.rolling_sum(df, ["e"], "m", "v", 3, MONEY), "m", "roll_3", "n_3")
    assert [x[1] for x in got] == [1, 3, 4, 12] and [x[2] for x in got] == [1, 2, 1, 2]


def test_change_vs_year_end(spark):
    df = series(spark, [("2024-12-01", 100), ("2025-01-01", 90), ("2025-03-01", 80), ("2026-01-01", 50)])
    got = rows(flows.change_vs_year_end(df, ["e"], "m", "v"), "m", "change_prior_month", "change_prior_year_end")
    assert [x[1:] for x in got] == [(None, None), (-10, -10), (None, -20), (None, None)]


def test_missing_periods_and_coverage(spark):
    df = series(spark, [("2025-01-01", 1), ("2025-04-01", 1), ("2025-05-01", 1)])
    assert rows(flows.missing_periods(df, ["e"], "m"), "missing_period") == [(d("2025-02-01"),), (d("2025-03-01"),)]
    c = flows.coverage(df, ["e"], "m").first()
    assert (c["present"], c["expected"], c["missing"]) == (3, 5, 2)


def test_four_quarter_sum_needs_four_quarters(spark):
    df = series(spark, [(f"2025-{m:02d}-01", 1) for m in range(1, 13)] + [("2026-04-01", 1)])
    got = rows(flows.four_quarter_sum(df, ["e"], "m", "v", MONEY), "obs_quarter", "four_quarter_sum")
    assert [x[1] for x in got] == [None, None, None, 12, None]


def test_splice_flags_mixed_bases(spark):
    s = "e string, m date, v int, basis string"
    a = spark.createDataFrame([("x", d("2019-01-01"), 1, "estimated"), ("x", d("2021-01-01"), 9, "estimated")], s)
    b = spark.createDataFrame([("x", d("2020-06-01"), 2, "disclosed"), ("y", d("2020-06-01"), 3, "disclosed")], s)
    got = rows(flows.splice(a, b, ["e"], "m", F.lit(d("2020-01-01"))), "e", "v", "source_basis", "basis")
    assert got == [("x", 1, "estimated", "spliced"), ("x", 2, "disclosed", "spliced"), ("y", 3, "disclosed", "disclosed")]


def test_carry_last_equals_plain_window(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("k"),
        F.timestamp_seconds(F.col("id") * 977).alias("ts"),
        "id",
        (F.xxhash64("id") % 10 == 0).alias("src"),
    )
    got = carry_last(df, ["k"], ["ts", "id"], F.col("src"), ["id"], F.date_trunc("day", "ts"))
    df.createOrReplaceTempView("carry_rows")
    want = spark.sql(
        "SELECT id, last(CASE WHEN src THEN id END, true) OVER (PARTITION BY k ORDER BY ts, id) AS last_id FROM carry_rows"
    )
    assert rows(got, "id", "last_id") == rows(want, "id", "last_id")


# ------------------------------------------------------------- joins


def test_prior_period_tie_skips_unmatched(spark):
    df = spark.createDataFrame(
        [
            ("e", d("2024-12-01"), 100.0, None, None), ("e", d("2025-01-01"), 110.0, 10.0, "prev_month"),
            ("e", d("2025-03-01"), 120.0, 20.0, "prev_year_end"), ("e", d("2025-05-01"), 1.0, 1.0, "prev_month"),
            ("f", d("2025-03-01"), 5.0, 5.0, "prev_year_end"),
        ],
        "e string, m date, v double, ch double, basis string",
    )
    p = joins.prior_period_rows(df, ["e"], "m", "v", "basis")
    c = reconcile(p, [Check("tie", F.col("ref_value") + F.col("ch"), F.col("v"))], ["e", "m"])
    assert rows(c, "m", "rel_error", "passed") == [(d("2025-01-01"), 0.0, True), (d("2025-03-01"), 0.0, True)]


def test_asof_join_ties_and_misses(spark):
    left = spark.createDataFrame([("u", 10, 1), ("u", 20, 2), ("v", 5, 3), ("u", 1, 4)], "k string, t int, id int")
    right = spark.createDataFrame([("u", 10, 1.0), ("u", 19, 2.0), ("v", 6, 3.0)], "k string, t int, rate double")
    got = asof_join(left, right, ["k"], "t", "t", ["rate"], lambda t: F.floor(t / 7))
    assert rows(got, "id", "asof_rate") == [(1, 1.0), (2, 2.0), (3, None), (4, None)]


def test_validity_join_half_open(spark):
    fact = spark.createDataFrame([("a", d("2025-12-31")), ("a", d("2026-01-01")), ("a", d("2010-01-01"))], "k string, m date")
    dim = spark.createDataFrame(
        [("a", d("2013-01-01"), d("2026-01-01"), "old"), ("a", d("2026-01-01"), None, "new")], "k string, f date, t date, name string"
    )
    assert rows(joins.validity_join(fact, dim, "k", F.col("m"), "f", "t"), "m", "name") == [
        (d("2025-12-31"), "old"), (d("2026-01-01"), "new")
    ]


def test_successors_follow_long_chains_and_find_cycles(spark):
    chain = [(i, i + 1) for i in range(40)] + [(40, None), (100, 101), (101, 100), (200, 999)]
    dim = spark.createDataFrame(chain, "k int, nxt int")
    got = {r["k"]: r["survivor"] for r in joins.resolve_successors(dim, "k", "nxt").collect()}
    assert all(got[i] == 40 for i in range(41))
    assert got[100] is None and got[101] is None and got[200] is None


def test_compare_channels_full_outer(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 50.0)], "m int, v double")
    b = spark.createDataFrame([(1, 101.0), (3, 7.0)], "m int, v double")
    assert rows(joins.compare_channels(a, b, ["m"], "v", 0.03), "m", "agrees") == [(1, True), (2, None), (3, None)]


def test_survivors_as_of_a_date_and_in_a_cycle(spark):
    s = "e string, s string, f date, t date"
    chain = [(f"c{i:02}", f"c{i + 1:02}" if i < 20 else None, None, d(f"20{i:02}-01-01")) for i in range(21)]
    dim = spark.createDataFrame([*chain, ("x", "y", None, d("2001-01-01")), ("y", "x", None, d("2003-01-01")), ("u", "nobody", None, d("2001-01-01"))], s)
    facts = spark.createDataFrame([("c00", d("1999-05-01")), ("c00", d("2007-01-01")), ("c03", d("2050-01-01")), ("x", d("2002-01-01")), ("x", d("2004-01-01")), ("u", d("2004-01-01")), (None, d("2004-01-01")), ("new", d("2004-01-01"))], "e string, at date")
    got = {(r["e"], str(r["at"])): (r["survivor"], r["hops"]) for r in joins.survivors_asof(dim, facts, "e", "at", "s", "t").collect()}
    assert got == {
        ("c00", "1999-05-01"): ("c00", 0), ("c00", "2007-01-01"): ("c08", 8), ("c03", "2050-01-01"): ("c20", 17), ("x", "2002-01-01"): ("y", 1),
        ("x", "2004-01-01"): (None, None), ("u", "2004-01-01"): ("u", 0), (None, "2004-01-01"): (None, 0), ("new", "2004-01-01"): ("new", 0),
    }
    kinds = {r["e"]: r["kind"] for r in joins.successor_breaks(dim, "e", "s", "f", "t").collect()}
    assert kinds["c20"] == "ended" and kinds["u"] == "unknown_successor" and kinds["c00"] == "succession"


def test_validity_sweep_equals_the_join_for_a_hot_entity(spark):
    rnd = __import__("random").Random(4)
    day = lambda n: d("2020-01-01") + dt.timedelta(days=n)
    fact = spark.createDataFrame([("hot" if i % 10 else f"k{i % 7}", day(rnd.randint(0, 900)), i) for i in range(2000)] + [("hot", None, -1), (None, day(3), -2)], "k string, at date, i int")
    dim = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", day(a := rnd.randint(-50, 900)), None if i % 9 == 0 else day(a + rnd.randint(0, 400)), i) for i in range(300)], "k string, f date, t date, version int")
    want = rows(joins.validity_join(fact, dim, "k", F.col("at"), "f", "t"), "i", "version")
    swept = joins.validity_sweep(fact, dim, "k", "at", "f", "t", bucket_days=30)
    assert rows(swept, "i", "version") == want and len(want) > 1000
    assert joins.validity_sweep(fact.filter("false"), dim, "k", "at", "f", "t").count() == 0


def test_merge_sources_earliest_wins(spark):
    a = spark.createDataFrame([("1", "t1")], "id string, title string")
    b = spark.createDataFrame([("1", "other"), ("2", "t2")], "id string, title string")
    assert rows(joins.merge_sources([a, b], "id", ["title"]), "id", "title", "source_no") == [("1", "t1", 0), ("2", "t2", 1)]


def test_containment_equals_brute_force(spark):
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["餘額達3,726億元", "Brown dogs jump, and 12 boxers march past", "the end", "brow n dogsjump,and12box", "", "aaaa" * 9])],
        "doc int, t string",
    )
    items = spark.createDataFrame(
        [(0, "3726億元"), (1, "dogs jump and 12 box"), (2, "e"), (3, "zzz"), (4, ""), (5, "aaaaaaaaaaaaaaaaaaaa"), (6, "the end")],
        "item int, v string",
    )
    from obslake.functions.text import text_norm

    want = docs.crossJoin(items).filter(
        F.contains(text_norm(F.col("t")), text_norm(F.col("v"))) & (text_norm(F.col("v")) != "")
    )
    got = containment.containment_pairs(docs, "doc", "t", items, "item", "v")
    assert rows(got, "doc", "item") == rows(want, "doc", "item")
    assert got.count() == 7


def test_containment_of_values_of_all_lengths(spark):
    rnd = __import__("random").Random(5)
    alphabet = "外匯價格變動準備金餘額ab12"
    texts = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200)))) for i in range(40)]
    values = [(i, t[1][p : p + n]) for i, (t, p, n) in enumerate((rnd.choice(texts), rnd.randint(0, 100), rnd.randint(1, 40)) for _ in range(150))]
    values += [(1000 + i, "".join(rnd.choice(alphabet) for _ in range(n))) for i, n in enumerate(range(1, 30))]
    got = containment.containment_pairs(spark.createDataFrame(texts, "doc int, t string"), "doc", "t", spark.createDataFrame(values, "item int, v string"), "item", "v")
    assert set(rows(got, "doc", "item")) == {(d_, i) for d_, t in texts for i, v in values if v and v in t} and got.count() == len(set(rows(got, "doc", "item")))


def test_values_with_one_head_propose_about_as_many_pairs_as_they_have_hits(spark):
    rnd = __import__("random").Random(8)
    han = [chr(0x4E00 + i) for i in range(2000)]
    head = "外匯價格變動準備金之提存方式"
    values = [(i, head + "".join(rnd.choice(han) for _ in range(16))) for i in range(1000)]
    texts = [(i, "".join(rnd.choice(han) for _ in range(50)) + values[i * 7 % 1000][1] + "".join(rnd.choice(han) for _ in range(50))) for i in range(300)]
    docs, items = spark.createDataFrame(texts, "doc int, t string"), spark.createDataFrame(values, "item int, v string")
    pairs = containment.candidate_pairs(docs, items)
    assert pairs.count() <= 2 * 300
    assert rows(containment.containment_pairs(docs, "doc", "t", items, "item", "v"), "doc", "item") == sorted(((i, i * 7 % 1000) for i in range(300)), key=str)
    # a text and a value choose the same fragments
    same = containment.fingerprints(docs, "doc", "t", 8, 8).filter("doc = 0").select("gram")
    own = containment.fingerprints(items, "item", "v", 8, 8).filter("item = 0").select("gram")
    assert own.subtract(same).count() == 0 and own.count() > 1


def test_texts_are_fingerprinted_once_and_do_not_travel(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(x):
        seen.add(1)
        return x

    text = F.udf(watched, "string").asNondeterministic()
    texts = spark.createDataFrame([(i, f"text number {i} with a passage of its own") for i in range(40)] + [(None, "x"), (50, None)], "doc int, t string")
    docs = texts.select("doc", text("t").alias("t"))
    items = spark.createDataFrame([(i, f"text number {i} with a passage") for i in range(10)], "item int, v string")
    grams = containment.candidate_pairs(docs.select("doc", F.coalesce("t", F.lit("")).alias("t")), items)
    assert seen.value == 42  # candidates are known, and each text has been read once
    assert sorted(map(tuple, grams.collect())) == [(i, i) for i in range(10)] and seen.value == 42
    got = containment.containment_pairs(texts, "doc", "t", items, "item", "v")
    assert rows(got, "doc", "item") == [(i, i) for i in range(10)]


def test_no_values_and_no_texts(spark):
    docs, items = spark.createDataFrame([(1, "abc")], "doc int, t string"), spark.createDataFrame([(1, "b")], "item int, v string")
    assert containment.containment_pairs(docs, "doc", "t", items.filter("false"), "item", "v").count() == 0
    assert containment.containment_pairs(docs.filter("false"), "doc", "t", items, "item", "v").count() == 0


# ------------------------------------------------------------- reconcile


def test_rel_error_with_zero_rhs_and_rounding_allowance(spark):
    df = spark.createDataFrame([(100.0, 0.0), (5.0, None), (103.0, 100.0), (104.0, 100.0)], "l double, r double")
    plain = reconcile(df, [Check("c", F.col("l"), F.col("r"))], ["l"])
    assert rows(plain, "l", "rel_error", "passed") == [(100.0, 100.0, False), (103.0, 0.03, True), (104.0, 0.04, False)]
    allowed = reconcile(df, [Check("c", F.col("l"), F.col("r"), abs_tolerance=150.0)], ["l"])
    assert all(r["passed"] for r in allowed.collect())
    pp = reconcile(df, [Check("c", F.col("l"), F.col("r"), relative=False, abs_tolerance=3.5)], ["l"])
    assert rows(pp, "l", "passed") == [(100.0, False), (103.0, True), (104.0, False)]


def test_gate_sees_checks_and_verifications(spark):
    ok = reconcile(spark.createDataFrame([(1.0, 1.0)], "l double, r double"), [Check("c", F.col("l"), F.col("r"))])
    bad = spark.createDataFrame([(False,), (True,)], "ok boolean")
    assert run_gate(ok).first()["status"] == "ok"
    g = run_gate(ok, bad).first()
    assert (g["status"], g["verifications_failed"], g["checks_failed"]) == ("fail", 1, 0)
    none = run_gate(ok.limit(0)).first()
    assert (none["status"], none["checks_total"]) == ("ok", 0)


def test_expectations_let_null_pass(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, 1.5), (0.5, None)], "a double, b double")
    es = [quality.not_null("a"), quality.in_range("b", 0, 2), quality.cross_column("a_lt_b", F.col("a") < F.col("b"))]
    got = {r["expectation"]: r["n_violations"] for r in quality.expectation_report(df, es, "t").collect()}
    assert got == {"a_not_null": 1, "b_range": 1, "a_lt_b": 0}
    assert rows(quality.violations(df, es, ["b"]), "expectation") == [("a_not_null",), ("b_range",)]


def test_status_expected(spark):
    df = spark.createDataFrame([(200, None), (302, None), (404, None), (403, 403), (200, 403)], "s int, e int")
    assert [r[0] for r in df.select(status_expected(F.col("s"), F.col("e"))).collect()] == [True, True, False, True, False]


# ------------------------------------------------------------- indicators


def test_ratios_guard_missing_and_zero(spark):
    df = spark.createDataFrame([(D(60), D(15), D(100)), (D(1), D(1), D(0)), (None, D(1), D(5))], "h decimal(20,4), p decimal(20,4), a decimal(20,4)")
    got = [r[0] for r in df.select(ind.economic_hedge_ratio(F.col("h"), F.col("p"), F.col("a"))).collect()]
    assert got == [0.75, None, None]


def test_weakest_basis(spark):
    df = spark.createDataFrame([("disclosed", "estimated"), ("disclosed", None), (None, None), ("press_reported", "disclosed")], "a string, b string")
    got = [r[0] for r in df.select(ind.weakest_basis(F.col("a"), F.col("b"))).collect()]
    assert got == ["estimated", "disclosed", None, "press_reported"]


def test_memo_and_restricted_tiers_never_count(spark):
    df = spark.createDataFrame([(d("2025-12-01"),), (d("2026-06-01"),)], "m date")
    L = lambda x: F.lit(x)
    t = ind.buffer_tiers(df, ["m"], "m", L(1000), L(100), L(50), L(30), L(20), L(500))
    got = {(r["m"], r["tier"]): (r["amount"], r["absorbable_pct"]) for r in t.collect()}
    assert got[(d("2025-12-01"), "b")] == (150.0, 15.0)
    assert got[(d("2026-06-01"), "b")] == (130.0, 13.0)
    assert got[(d("2026-06-01"), "c_restricted")] == (20.0, None) and got[(d("2026-06-01"), "d_memo")] == (500.0, None)
    assert len(got) == 6


def test_reserve_fold(spark):
    s = "e string, m date, delta double, x double, rate double, v0 double, f0 double"
    df = spark.createDataFrame(
        [
            ("a", d("2026-01-01"), 50.0, 1000.0, 0.01, 20.0, 5.0),   # vol 70, fixed 15
            ("a", d("2026-02-01"), -80.0, 1000.0, 0.01, 0.0, 0.0),   # vol 0, fixed 25-10=15
            ("a", d("2026-03-01"), -100.0, 1000.0, 0.01, 0.0, 0.0),  # fixed 25 gone, 75 uncovered
            ("a", d("2026-04-01"), 10.0, 1000.0, 0.5, 0.0, 0.0),     # fixed capped at 100
        ],
        s,
    )
    out = reserves.reserve_rollforward(df, "e", "m", "delta", "x", "rate", "v0", "f0")
    got = [tuple(r)[2:] for r in sorted(out.collect(), key=lambda r: r["obs_month"])]
    assert got == [(70.0, 15.0, 0.0), (0.0, 15.0, 0.0), (0.0, 0.0, 75.0), (10.0, 100.0, 0.0)]


def test_volatility_delta_half_rate(spark):
    df = spark.createDataFrame([(100.0, "100", 1200.0, 0.01), (100.0, "50", 1200.0, 0.01), (-100.0, "50+", 1200.0, -0.01)], "g double, c string, p double, d double")
    got = [round(r[0], 6) for r in df.select(reserves.volatility_delta(F.col("g"), F.col("c"), F.col("p"), F.col("d"))).collect()]
    assert got == [100.0, 49.75, -49.75]


def test_special_reserve_stops_at_twice_the_cap(spark):
    df = spark.createDataFrame(
        [("a", 2026, 1000.0, 30.0, 30.0, 0.0), ("a", 2027, 1000.0, 30.0, 30.0, 0.0), ("a", 2028, -5.0, 0.0, 90.0, 0.0)],
        "e string, y int, profit double, ded double, cap double, b0 double",
    )
    got = [tuple(r)[1:] for r in reserves.special_reserve_fixed(df, "e", "y", "profit", "ded", "cap", "b0").collect()]
    assert got == [(2026, 70.0, 70.0), (2027, 0.0, 70.0), (2028, 0.0, 70.0)]


def test_strengthening_reserve_deducts_and_floors(spark):
    df = spark.createDataFrame([(10000.0, 0.6, 0.4, 10.0, 5.0), (10000.0, 0.4, 0.6, 0.0, 0.0)], "m double, b double, c double, f double, k double")
    got = [round(r[0], 6) for r in df.select(reserves.strengthening_reserve(*[F.col(c) for c in "mbcfk"])).collect()]
    assert got == [35.0, 0.0]


# ------------------------------------------------------------- aggregates


def test_ordered_text_returns_long_groups_whole(spark):
    df = spark.range(25).select(F.lit("k").alias("k"), F.col("id").alias("pos"), F.col("id").cast("string").alias("t"))
    got = aggregates.ordered_text(df, ["k"], "pos", F.col("t"), "-", chunk=10).orderBy("chunk_no").collect()
    assert [r["n_parts"] for r in got] == [10, 10, 5]
    assert "-".join(r["text"] for r in got) == "-".join(str(i) for i in range(25))


def test_month_mean_vs_history(spark):
    df = spark.createDataFrame(
        [("e", d("2024-11-05"), 2.0), ("e", d("2024-12-05"), 100.0), ("e", d("2025-01-05"), 4.0), ("e", d("2025-01-06"), 6.0), ("e", d("2026-03-01"), 1.0)],
        "e string, day date, v double",
    )
    got = rows(aggregates.month_mean_vs_history(df, ["e"], "day", "v"), "obs_month", "month_mean", "history_mean")
    assert got[2:] == [(d("2025-01-01"), 5.0, 2.0), (d("2026-03-01"), 1.0, 28.0)]
    assert got[0][2] is None


def test_regression_backfill_marks_estimates(spark):
    df = spark.createDataFrame([("e", float(x), 2.0 * x + 1 if x > 2 else None) for x in range(1, 9)], "e string, x double, y double")
    got = sorted(aggregates.regression_backfill(df, ["e"], "y", "x").collect(), key=lambda r: r["x"])
    assert [r["basis"] for r in got[:3]] == ["estimated", "estimated", "disclosed"]
    assert abs(got[0]["value"] - 3.0) < 1e-9 and got[0]["ci_low"] is not None and got[5]["ci_low"] is None


# ------------------------------------------------------------- plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_vintage_is_limited_before_the_shuffle(spark):
    p = plan(vt.latest_vintage(store(spark), ["m", "channel"], "vintage"))
    assert "WindowGroupLimit" in p and p.count("Exchange") == 1


def test_bucketed_store_reads_without_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stores LOCATION '{tmp_path}/db'")
    append.save_store(store(spark), "stores.obs", ["m", "channel"], "vintage", 4)
    got = vt.latest_vintage(spark.table("stores.obs"), ["m", "channel"], "vintage")
    assert "Exchange" not in plan(got) and got.count() == 3
    spark.sql("DROP TABLE stores.obs")


def test_append_shuffles_each_side_once(spark):
    b = spark.range(100).selectExpr("id AS k", "id % 3 AS m", "id AS seq")
    t = spark.range(50).selectExpr("id AS k", "id % 3 AS m", "id AS seq")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = append.new_rows(b, t, ["k", "m"], ["seq"])
        assert plan(fresh).count("Exchange hashpartitioning") == 2
        assert fresh.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_nested_loops_or_cross_products(spark, sf_dir):
    from obslake.plans import all_queries

    bad = [n for n, q in all_queries().items() if not n.startswith("stream_") and ("NestedLoop" in (p := plan(q(spark, sf_dir))) or "Cartesian" in p)]
    assert not bad


def test_provenance_survives_aggregation(spark):
    df = spark.createDataFrame(
        [("s", d("2026-01-01"), d("2026-01-05"), "disclosed", "b; a", "doc1"), ("s", d("2026-02-01"), d("2026-02-02"), "estimated", "c; a", "doc1")],
        "k string, vintage date, retrieved_at date, basis string, sources string, doc string",
    )
    r = df.groupBy("k").agg(*ind.carried_provenance()).first()
    assert tuple(r) == ("s", d("2026-02-01"), d("2026-02-02"), "estimated", "a; b; c")
    assert rows(ind.provenance_links(df, ["k"], "doc"), "k", "doc") == [("s", "doc1")]


def test_sector_rows_without_entity_join(spark):
    s = "e string, m date, v double, ch double, basis string"
    df = spark.createDataFrame([(None, d("2025-01-01"), 10.0, None, None), (None, d("2025-02-01"), 12.0, 2.0, "prev_month")], s)
    assert joins.prior_period_rows(df, ["e"], "m", "v", "basis").count() == 1
    rows_ = spark.createDataFrame([(None, 1, True, 5), (None, 9, False, 6), ("a", 9, False, 7)], "k string, t int, src boolean, id int")
    got = carry_last(rows_, ["k"], ["t"], F.col("src"), ["id"], F.floor(F.col("t") / 2))
    assert rows(got, "id", "last_id") == [(5, 5), (6, 5), (7, None)]
    fit = spark.createDataFrame([(None, float(x), 2.0 * x if x > 1 else None) for x in range(1, 6)], "e string, x double, y double")
    assert abs(aggregates.regression_backfill(fit, ["e"], "y", "x").filter("y IS NULL").first()["value"] - 2.0) < 1e-9


def test_append_joins_the_touched_partitions(spark, tmp_path):
    t = spark.range(60).selectExpr("id AS k", "date_add(DATE'2026-01-01', CAST(id % 6 AS INT)) AS m", "id AS seq")
    t.write.partitionBy("m").parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = t.filter("m = DATE'2026-01-02'").unionByName(spark.sql("SELECT 999L AS k, DATE'2026-01-03' AS m, 1L AS seq"))
    fresh = append.new_rows(batch, target, ["k", "m"], ["seq"], "m")
    assert rows(fresh, "k") == [(999,)]
    with pytest.raises(ValueError):
        append.new_rows(batch, target, ["k"], ["seq"], "m")


def test_append_new_writes_only_fresh_rows(spark, tmp_path):
    path = str(tmp_path / "store")
    batch = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 0)], "k string, v int, seq int")
    append.append_new(batch, path, None, ["k"], ["seq"])
    append.append_new(batch.unionByName(spark.createDataFrame([("c", 4, 0)], batch.schema)), path, spark.read.parquet(path), ["k"], ["seq"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 3), ("c", 4)]
