import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from obslake.functions import calendar as cal
from obslake.functions import facts, numbers as num, text as tx


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "cell,expected",
    [
        ("1,234", 1234), ("(1,234)", -1234), ("（1，234）", -1234), ("負1,518", -1518), ("－5", -5), ("(-5)", -5),
        ("-", None), ("－", None), ("—", None), ("--", None), ("─", None), ("", None), ("abc", None), (" 12 ", 12),
        ("1　234 ", 1234), ("-0.44", D("-0.44")),
    ],
)
def test_parse_number(spark, cell, expected):
    got = one(spark, cell, num.parse_number)
    assert got == (None if expected is None else D(expected))


@pytest.mark.parametrize(
    "printed,kind,expected",
    [
        ("8兆6073億元", "amount", 8607300), ("1兆648億元", "amount", 1064800), ("23兆元", "amount", 23000000),
        ("15.6兆元", "amount", 15600000), ("823.37億元", "amount", 82337), ("3,726億元", "amount", 372600),
        ("-682億元", "amount", -68200), ("0元", "amount", 0), ("31.648", "amount", D("31.648")),
        ("66.39%", "fraction", D("0.6639")), ("10.6%", "pct", D("10.6")), ("12％", "pct", 12),
        ("several", "amount", None), ("-1兆2億元", "amount", -1000200),
    ],
)
def test_scale_units(spark, printed, kind, expected):
    got = one(spark, printed, lambda c: num.scale_units(c, kind))
    assert got == (None if expected is None else D(expected))


@pytest.mark.parametrize("y,m,expected", [(115, 6, dt.date(2026, 6, 1)), (107, 5, dt.date(2018, 5, 1)), (107, 13, None)])
def test_roc_month(spark, y, m, expected):
    r = spark.createDataFrame([(y, m)], "y int, m int").select(cal.roc_month(F.col("y"), F.col("m")).alias("d")).first()
    assert r["d"] == expected


@pytest.mark.parametrize("v,expected", [("44700", "44700"), ("-0.44", "-0.44"), ("2.50", "2.5"), ("100", "100"), ("0", "0")])
def test_decimal_text(spark, v, expected):
    assert one(spark, v, lambda c: num.decimal_text(c.cast("decimal(20,4)"))) == expected


@pytest.mark.parametrize(
    "printed,text,boundary,expected",
    [
        ("3,726億元", "餘額達3726億元，", False, True), ("3,726億元", "餘額達 3,726 億", False, True),
        (">75%", "超過75％以上", False, True), ("0", "no digits", False, False), ("0", "10", False, True),
        ("47%", "147%", False, True), ("47%", "147%", True, False), ("47%", "達47%。", True, True),
        ("-682億元", "減少682億", False, True), ("88億元", "77億元", False, False),
    ],
)
def test_literal_in_text(spark, printed, text, boundary, expected):
    df = spark.createDataFrame([(printed, text)], "p string, t string")
    assert df.select(tx.literal_in_text(F.col("p"), F.col("t"), boundary).alias("y")).first()["y"] is expected


def test_first_label_takes_list_order(spark):
    labels = [("避險工具損益", "instrument"), ("避險損益", "hedging")]
    assert one(spark, "避險損益(2)避險工具損益", lambda c: facts.first_label(c, labels)) == "instrument"
    assert one(spark, "其他", lambda c: facts.first_label(c, labels)) is None


def test_numeric_cells_keep_dashes(spark):
    df = spark.createDataFrame([(["兌換損益", "1,200", "-", "(30)"],)], "a array<string>")
    nums = num.numeric_cells(F.col("a"))
    r = df.select(nums.alias("n"), num.pad_three(nums).alias("t")).first()
    assert r["n"] == [D(1200), None, D(-30)]
    assert tuple(r["t"]) == (D(1200), None, D(-30))
    short = spark.createDataFrame([(["x", "5"],)], "a array<string>")
    assert short.select(num.pad_three(num.numeric_cells(F.col("a"))).alias("t")).first()["t"] is None


def test_text_bound(spark):
    r = spark.createDataFrame([(">75%",), ("約1,200億",), ("75",)], "x string").select(
        num.bound_operator(F.col("x")).alias("o"), num.bound_value(F.col("x")).alias("v")
    ).collect()
    assert [(x["o"], x["v"]) for x in r] == [(">", D(75)), ("約", D(1200)), (None, D(75))]


@pytest.mark.parametrize(
    "day,freq,label",
    [("2024-04-15", "Q", "2Q24"), ("2024-03-01", "M", "Mar-24"), ("2024-12-31", "M", "Dec-24"), ("2024-03-05", "D", "5-Mar-24"), ("2024-07-01", "A", "2024")],
)
def test_axis_labels(spark, day, freq, label):
    assert one(spark, day, lambda x: cal.period_label(F.to_date(x), freq)) == label
    assert 2024 <= one(spark, day, lambda x: cal.axis_position(F.to_date(x), freq)) < 2025


def test_period_arithmetic(spark):
    r = spark.sql("SELECT DATE '2025-01-15' AS d").select(
        cal.prior_month(F.col("d")).alias("m"), cal.prior_year_end(F.col("d")).alias("y"), cal.quarter_start(F.col("d")).alias("q"),
        cal.id_date(F.lit("20260127xyz")).alias("i"), cal.id_date(F.lit("no date")).alias("n"),
    ).first()
    assert (r["m"], r["y"], r["q"]) == (dt.date(2024, 12, 1), dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    assert r["i"] == dt.date(2026, 1, 27) and r["n"] is None


def test_urls(spark):
    u = "https://news.example.com/story/5613/9292493.html?x=1#top"
    assert one(spark, u, tx.url_host) == "news.example.com"
    assert one(spark, "https://a.b/story/5613/9292493/", tx.url_last_id) == "9292493"
    assert one(spark, "https://a.b/c-d?e", tx.url_safe_key) == "a_b_c_d_e"
    df = spark.createDataFrame([("https://a.b/c/", "https://a.b/c")], "a string, b string")
    assert df.select(tx.same_url(F.col("a"), F.col("b")).alias("s")).first()["s"]


def test_page_paragraphs_survive_scripts_and_unclosed_tags(spark):
    html = '<title> A &amp; B </title><script>var t="</p><p>no";</script><nav><p>menu</p></nav><p>one <b>1</b><p class="x">two&nbsp;2</p><!-- <p>gone</p> -->'
    assert one(spark, html, tx.page_paragraphs) == ["one 1", "two 2"]
    assert one(spark, html, tx.page_title) == "A & B"


def test_fact_specs(spark):
    specs = [
        facts.FactSpec("move", r"(升值|貶值)幅度為([\d.]+)%", 2, sign_group=1, signs={"貶值": -1}, unless="幅度為9"),
        facts.FactSpec("income", r"為(負)?([\d,]+)億元", 2, 100, 1, {"負": -1}),
    ]
    df = spark.createDataFrame([("貶值幅度為2.5%，利益為負1,200億元",), ("升值幅度為9.1%",), ("無",)], "x string")
    got = [tuple(r) for r in facts.extract_facts(df, F.col("x"), specs).select("move", "income").collect()]
    assert got == [(D("-2.5"), D(-120000)), (None, None), (None, None)]


def test_references_are_decoded_once(spark):
    s = "a&nbsp;b &#8211; &#x37;0&#37; &mdash; &hellip; &amp;lt; &lt; &#128512; &unknown; &#0; &#xD800; & alone"
    assert one(spark, s, tx.unescape) == "a b – 70% — … &lt; < 😀 &unknown; &#0; &#xD800; & alone"
    assert one(spark, "no reference", tx.unescape) == "no reference"


def test_chrome_closes_with_its_own_name(spark):
    html = "<header><nav><p>menu</p></nav><p>Masthead</p></header><p>one</p><aside><p>x</p></aside ><footer><script>'</footer>'</script><p>end</p></footer><p>two"
    assert one(spark, html, tx.page_paragraphs) == ["one", "two"]


def test_boundary_equals_a_pattern_per_value(spark):
    """Values with pattern characters, values that touch and values that overlap themselves."""
    import random
    import re

    rnd = random.Random(1)
    pick = lambda n: "".join(rnd.choice("1.2aa\\E[") for _ in range(rnd.randint(0, n)))
    pairs = [(pick(4), pick(14)) for _ in range(1500)] + [("\\E", "x\\Ey"), ("a.a", "1a.a.a1"), ("1a1", "51a1a1 "), ("47", "4747"), ("", "x")]
    pairs = [(p, t) for p, t in pairs if p != "0"]
    df = spark.createDataFrame(pairs, "p string, t string")
    got = [r["y"] for r in df.select(tx._stands_alone(F.col("t"), F.col("p")).alias("y")).collect()]
    want = [bool(re.search("(?<![0-9.])" + re.escape(p) + "(?![0-9])", t)) if p else True for p, t in pairs]
    assert [x for x in zip(pairs, got, want) if x[1] != x[2]] == []


def test_full_width_figures_keep_their_column(spark):
    from obslake.functions import numbers as nb

    df = spark.createDataFrame([(["項目", "１２３", "－４，５６７．８", "-", "9"],)], "r array<string>")
    got = df.select(nb.numeric_cells(F.col("r")).alias("n")).head()["n"]
    assert [None if x is None else float(x) for x in got] == [123.0, -4567.8, None, 9.0]


@pytest.mark.parametrize("cell,expected", [("1e3", 1000), ("(負2.5)", D("-2.5")), ("٣", 3), ("+7", 7), (".5", D("0.5")), ("12x", None), ("e", None), ("1-2", None), (None, None), ("負", None), ("1:2", None)])
def test_parse_number_of_odd_cells(spark, cell, expected):
    got = one(spark, cell, num.parse_number)
    assert got == (None if expected is None else D(expected))


def test_words_are_told_before_they_are_cast(spark):
    df = spark.createDataFrame([("word",)], "x string").select(num.parse_number(F.col("x")).alias("y"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and plan.index("RLIKE") < plan.index("try_cast" if "try_cast" in plan else "cast(")


def test_words_counted_within_rows(spark):
    import types
    from collections import Counter

    from obslake.plans.q_text import parse_number

    rows = [(1, "b a b  12 "), (2, ""), (3, None), (4, "(1,2) (1,2)"), (4, "x (1,2)"), (None, "7 y"), (None, "y"), (5, "\n x \n")]
    out = parse_number(types.SimpleNamespace(documents=spark.createDataFrame(rows, "doc_id long, text string")))
    expected = Counter((i, w) for i, t in rows if t is not None for w in t.split(" "))
    assert {(r["doc_id"], r["token"]): r["n"] for r in out.collect()} == expected and out.count() == len(expected)
    assert {r["token"]: r["value"] for r in out.collect() if r["value"] is not None} == {"12": 12.0, "(1,2)": -12.0, "7": 7.0}
    # words of rows with ids of their own meet in no shuffle
    counted = tx.counted_parts(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], F.split("text", " "), "token")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
