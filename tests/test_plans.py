"""End-to-end plans on hand-built pages and the published figures."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from obslake.operators.joins import prior_period_rows
from obslake.operators.reconcile import Check, reconcile, run_gate
from obslake.plans import briefing, releases
from obslake.sources import landed, sinks


def d(s):
    return dt.date.fromisoformat(s)


# ------------------------------------------------------------- releases


def page(title, body, date="2020-04-28", main="maincontent"):
    return (
        f'<html><div class="{main}"><div class="subject"><h3>{title}</h3></div><div class="date">{date}</div>'
        f'<div class="page-edit">{body}</div></div></html>'
    )


def table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


PRETAX = "<p>一、稅前損益</p>" + table(("壽險業", "1,000"), ("產險業", "(50)"), ("合計", "950"))
EQUITY = "<p>二、淨值</p>" + table(("壽險業", "2,000"), ("產險業", "100"), ("合計", "2,101"))
FX = "<p>三、匯兌</p>" + table(
    ("項目", "壽險業", "產險業", "合計"),
    ("兌換損益(1)", "-3,000", "-", "-3,000"),
    ("避險損益(2)", "避險工具損益", "2,500", "10", "2,510"),
    ("避險工具換匯成本", "(400)", "-", "(400)"),
    ("外匯價格變動準備淨變動(3)", "300", "0", "300"),
    ("合計數", "-600", "10", "-590"),
    ("兌換損益(重複)", "9", "9", "9"),
)
STORY = (
    "<p>外匯價格變動準備金累積餘額達 613 億元，較去年底減少 20 億元。新臺幣兌美元匯率較去年底貶值幅度為1.5%。"
    "國外投資淨利益為負 1,234 億元。影響合計數為 負600 億元，一次性提存 5 億元。</p>"
)
TITLE = "109年3月保險業損益、淨值，以及兌換損益、避險損益與外匯價格變動準備金情形"


@pytest.fixture(scope="module")
def parsed(spark):
    empty_header = "<table><tr><td>一、稅前損益 壽險業</td></tr></table>"
    docs = [
        ("202004280001", page(TITLE, PRETAX + EQUITY + FX + STORY)),
        ("202005280002", page("109年4月保險業兌換損益情形", empty_header + table(("壽險業", "7"), ("壽險業", "8")) + FX.replace("避險工具換匯成本", "其他") + "<p>避險交易之換匯成本已達77億元。壽險業資產29.8兆元，國外投資17.7兆元。</p>", date="not a date")),
        ("202005280003", page("109年4月保險業損益", PRETAX)),
        ("202005280004", page("other news", FX)),
        ("202005280005", "<html>nothing</html>"),
    ]
    good, rejects = releases.parse_releases(spark.createDataFrame(docs, "doc_id string, html string"))
    return {r["doc_id"]: r for r in good.collect()}, {r["doc_id"]: r["reject_reason"] for r in rejects.collect()}, good


def test_release_rejects(parsed):
    assert parsed[1] == {
        "202005280003": "fx_rows_absent", "202005280004": "title_without_month", "202005280005": "body_absent"
    }


def test_release_tables(parsed):
    r = parsed[0]["202004280001"]
    assert (r["obs_month"], r["published"]) == (d("2020-03-01"), d("2020-04-28"))
    assert (r["pretax_profit_life"], r["pretax_profit_nonlife"], r["pretax_profit_total"]) == (D(100000), D(-5000), D(95000))
    assert (r["owners_equity"], r["owners_equity_total"]) == (D(200000), D(210100))
    assert r["fx_gain_loss"] == D(-300000)
    assert (r["hedging_instrument_gain_loss"], r["hedging_swap_cost"]) == (D(250000), D(-40000))
    assert r["hedging_gain_loss"] == D(210000) and r["hedging_split_available"]
    assert (r["fx_reserve_net_change"], r["fx_combined_effect"]) == (D(30000), D(-60000))


def test_release_narrative(parsed):
    r = parsed[0]["202004280001"]
    assert (r["fx_reserve_total"], r["fx_reserve_change"], r["fx_reserve_change_basis"]) == (D(61300), D(-2000), "prev_year_end")
    assert r["twd_change_ytd_pct"] == D("-1.5") and r["net_foreign_investment_income"] == D(-123400)
    assert (r["fx_combined_effect_narrative"], r["one_off_provision"]) == (D(-60000), D(500))
    assert r["warnings"] == []


def test_release_fallbacks_and_warnings(parsed):
    r = parsed[0]["202005280002"]
    assert (r["published"], r["obs_month"]) == (d("2020-05-28"), d("2020-04-01"))
    assert r["pretax_profit_life"] == D(800)  # the one-cell table holds no rows; a label's last row wins
    assert r["hedging_swap_cost"] == D(-7700) and not r["hedging_split_available"]
    assert (r["total_assets"], r["foreign_investments"]) == (D(29800000), D(17700000))
    assert r["warnings"] == [
        "equity_table_absent", "balance_not_stated", "currency_move_not_stated", "swap_cost_from_prose"
    ]


def one(spark, body):
    good, _ = releases.parse_releases(spark.createDataFrame([("202004280001", page(TITLE, body))], "doc_id string, html string"))
    return good.head()


def test_release_figures_behind_references_and_in_full_width(spark):
    wide = "".join(chr(0xFF10 + int(c)) if c.isdigit() else c for c in "-3,000")
    body = "<p>&#19977;、匯兌&nbsp;</p>" + table(("兌換損益", "&nbsp;-3,000", "-3,100"), ("避險損益", wide, "１２．５"), ("合計數&#40;1&#41;", "&#45;600", "10&nbsp;"))
    r = one(spark, body)
    assert (r["fx_gain_loss"], r["hedging_gain_loss"], r["fx_combined_effect"]) == (D(-300000), D(-300000), D(-60000))
    assert "fx_row_without_figures" not in r["warnings"]


def test_release_tables_inside_tables(spark):
    inner = table(("避險損益", "5", "6"))
    outer = "<table><tr><td>三、兌換損益</td></tr><tr><td>" + inner + table(("準備淨變動", "7", "8")) + "</td></tr><tr><td>兌換損益</td><td>-1</td><td>-2</td></tr></table>"
    story = "<table><tr><td>合計數</td><td>9</td><td>9</td></tr></table>"
    r = one(spark, "</table>" + PRETAX + outer + story)
    assert (r["fx_gain_loss"], r["hedging_gain_loss"], r["fx_reserve_net_change"]) == (D(-100), D(500), D(700))
    assert r["fx_combined_effect"] is None  # another table; the first that yields stands
    assert r["pretax_profit_life"] == D(100000)


def test_release_row_without_figures_is_told(spark):
    r = one(spark, table(("兌換損益", "-3,000元", "-3,1oo"), ("合計數", "-600", "10")))
    assert r["fx_gain_loss"] is None and "fx_row_without_figures" in r["warnings"]


def test_release_checks_and_projection(spark, parsed):
    checks = reconcile(parsed[2], releases.edition_checks(), ["doc_id"])
    got = {(r["doc_id"], r["check_name"]): r["passed"] for r in checks.collect()}
    assert got[("202004280001", "equity_parts_add_up")] and got[("202004280001", "fx_total_as_in_prose")]
    assert len([k for k in got if k[0] == "202004280001"]) == 4 and all(v for k, v in got.items() if k[0] == "202004280001")
    obs = releases.to_observations(parsed[2], "https://host.example/view?id=%s", F.current_timestamp())
    o = {r["source_id"]: r for r in obs.collect()}["202005280002"]
    assert o["source_url"] == "https://host.example/view?id=202005280002" and o["reporting_channel"] == "release"
    assert o["source_note"].startswith("equity_table_absent; ") and o["vintage"] == d("2020-05-28")


def test_release_run_appends_and_ties(spark):
    def edition(serno, title, balance, change):
        story = f"<p>外匯價格變動準備金累積餘額達{balance}億元，較去年底{change}億元。</p>"
        return serno, page(title, FX + story, date=f"{serno[:4]}-{serno[4:6]}-{serno[6:8]}")

    first = [edition("202001280001", "108年12月保險業兌換損益情形", 600, "減少5"), edition("202004280001", "109年3月保險業兌換損益情形", 580, "減少20")]
    docs = spark.createDataFrame(first, "doc_id string, html string")
    run = releases.run_releases(docs, None, "u/%s", F.lit("2026-01-01").cast("timestamp"))
    ties = run["checks"].filter("check_name = 'balance_follows_from_change'").collect()
    assert [(r["obs_month"], r["lhs"], r["rhs"], r["passed"]) for r in ties] == [(d("2020-03-01"), 58000.0, 58000.0, True)]
    assert run["gate"].first()["status"] == "ok"

    later = first + [edition("202005280001", "109年4月保險業兌換損益情形", 700, "增加1")]
    again = releases.run_releases(
        spark.createDataFrame(later, "doc_id string, html string"), run["observations"], "u/%s", F.lit("2026-02-01").cast("timestamp")
    )
    kept = {r["obs_month"]: r["retrieved_at"].month for r in again["observations"].collect()}
    assert kept == {d("2019-12-01"): 1, d("2020-03-01"): 1, d("2020-04-01"): 2}
    assert again["gate"].first()["status"] == "fail"


def test_header_out_of_reach(spark):
    body = "<p>一、稅前損益</p><p>" + "長" * 500 + "</p>" + table(("壽險業", "1"), ("合計", "1")) + FX
    good, _ = releases.parse_releases(spark.createDataFrame([("202004280001", page(TITLE, body))], "doc_id string, html string"))
    r = good.first()
    assert r["pretax_profit_life"] is None and "pretax_table_absent" in r["warnings"]


def test_listing_and_titles(spark):
    html = (
        f'<a href="x?dataserno=20200428&dtable=News" title="t"> {TITLE} </a>'
        '<a href="x?dataserno=20200428&dtable=News">second title of the id</a>'
        '<a href="x?dataserno=20260701&a=b">壽險業115年截至6月底外幣保險商品銷售情形</a><a href="x?dataserno=3">unrelated news</a>'
    )
    items = landed.listing_items(spark.createDataFrame([("p", html)], "p string, h string"), ["p"], "h", releases.LISTING_ITEM)
    got = landed.titled_periods(items, "title", releases.TITLE_FAMILIES).collect()
    assert sorted((r["id"], r["family"], r["reference_month"]) for r in got) == [
        ("20200428", "monthly_release", d("2020-03-01")), ("20260701", "policy_sales", d("2026-06-01"))
    ]


# ------------------------------------------------------------- published figures

COLS = (
    "obs_month ratio memo foreign_inv denominator net reserve p q x y buffer absorb"
).split()
GOLD = [
    ("2024-12-01", .6639, None, 23000000, 15600000, None, None, None, None, None, None, None, None),
    ("2025-08-01", .6225, None, None, None, None, 372600, None, None, None, None, None, None),
    ("2025-10-01", .5855, None, None, None, None, 384500, None, None, None, None, None, None),
    ("2025-12-01", .5023, None, 22800000, 15400000, 7700000, 613700, None, None, 289700, None, None, None),
    ("2026-01-01", .47, None, None, None, None, None, None, None, None, None, None, None),
    ("2026-02-01", .451, None, None, None, None, 625900, 615900, 10000, 289700, None, 915600, None),
    ("2026-03-01", .4515, .5575, None, None, 8607300, 621400, 600600, 20800, 289700, 0, 911100, 10.6),
    ("2026-04-01", .4431, .5541, None, None, 8702400, 680100, 648600, 31500, 289700, 0, 969800, 11.1),
    ("2026-05-01", .4366, None, None, None, 8775500, 691300, 649000, 42300, 289700, 0, 981000, 11.2),
    ("2026-06-01", .4289, .55, None, None, 8944900, 699700, None, None, 365100, None, 1064800, 11.9),
    ("2026-07-01", .4294, None, None, None, 9041700, 718200, None, None, 365100, None, 1083300, 12.0),
]
FIELD_OF = dict(
    ratio="hedge_ratio_regulatory", memo="effective_hedge_ratio_memo", foreign_inv="foreign_investments",
    denominator="regulatory_fx_exposure", net="net_fx_exposure", reserve="fx_reserve_total", p="fx_reserve_volatility",
    q="fx_reserve_fixed", x="special_reserve_fx_fixed", y="special_reserve_fx_strengthening", buffer="fx_buffer_total",
    absorb="buffer_absorbable_appreciation_pct",
)
GOLD_CHECKS = {
    ("2025-12-01", "net_exposure_from_ratio"): 0.0046,
    **{(f"2026-{m:02d}-01", "reserve_parts_add_up"): 0.0 for m in (2, 3, 4, 5)},
    **{(f"2026-{m:02d}-01", "buffer_parts_add_up"): 0.0 for m in (2, 3, 4, 5, 6, 7)},
    ("2026-03-01", "absorbable_move_from_buffer"): 0.001396, ("2026-04-01", "absorbable_move_from_buffer"): 0.003969, ("2026-05-01", "absorbable_move_from_buffer"): 0.001888,
    ("2026-06-01", "absorbable_move_from_buffer"): 0.000335, ("2026-07-01", "absorbable_move_from_buffer"): 0.001571,
}


def printed(col, v):
    if col in ("ratio", "memo"):
        return f"{v * 100:.2f}%"
    if col == "absorb":
        return f"{v}%"
    if v == 0:
        return "0元"
    if v >= 1_000_000:
        rest = (v % 1_000_000) // 100
        return f"{v // 1_000_000}兆{rest}億元" if rest else f"{v // 1_000_000}兆元"
    return f"{v // 100:,}億元"


def figure_rows():
    for row in GOLD:
        r = dict(zip(COLS, row))
        yield r["obs_month"], {FIELD_OF[c]: printed(c, r[c]) for c in COLS[1:] if r[c] is not None}


@pytest.fixture(scope="module")
def config_and_articles(spark, tmp_path_factory):
    rows, arts = [], []
    for i, (month, fields) in enumerate(figure_rows()):
        url = f"https://press.example/story/{i}/{9000 + i}"
        items = list(fields.items())
        first, second = dict(items[:1]), dict(items[1:])
        src = [{"url": url, "published": "2026-09-01", "outlet": "paper", "quote": f"q{i}", "fields": {**first, "hedge_cs_share_note": ">75%"}}]
        if second:
            src.append({"url": url + "b", "published": "2026-09-02", "outlet": "paper", "quote": f"r{i}", "fields": second})
        rows.append({"obs_month": month, "reported_by": "bureau", "note": "n", "sources": src})
        arts.append((url, f"<title>T{i}</title><p>{'、'.join(first.values())}</p>"))
        arts.append((url + "b", f"<p>{'、'.join(second.values())}</p>"))
    path = tmp_path_factory.mktemp("cfg") / "figures.json"
    path.write_text(json.dumps({"_doc": ["x"], "rows": rows}, ensure_ascii=False), encoding="utf-8")
    return landed.read_figure_config(spark, str(path)), arts


def test_briefing_golden_checks(spark, config_and_articles):
    config, arts = config_and_articles
    run = briefing.run_briefing(config, spark.createDataFrame(arts, "url string, html string"))
    got = {(r["obs_month"].isoformat(), r["check_name"]): r for r in run["checks"].collect()}
    assert len(got) == len(GOLD_CHECKS) == 16
    for (month, name), err in GOLD_CHECKS.items():
        (row,) = [r for (m, n), r in got.items() if m == month and n.startswith(name)]
        assert row["rel_error"] == pytest.approx(err, abs=1e-6) and row["passed"]
    gate = run["gate"].first()
    assert (gate["status"], gate["checks_total"], gate["checks_failed"], gate["verifications_failed"]) == ("ok", 16, 0, 0)


def test_briefing_rows(spark, config_and_articles):
    config, arts = config_and_articles
    rows = briefing.run_briefing(config, spark.createDataFrame(arts, "url string, html string"))["rows"]
    r = {x["obs_month"].isoformat(): x for x in rows.collect()}
    mar = r["2026-03-01"]
    assert mar["net_fx_exposure"] == D(8607300) and mar["hedge_ratio_regulatory"] == D("0.4515")
    assert mar["source_quote"] == "q6 ‖ r6" and mar["source_doc"] == "paper: T6" and mar["source_id"] == "9006"
    assert mar["source_note"] == "n also=https://press.example/story/6/9006b (2026-09-02)"
    assert mar["hedge_cs_share_note"] == ">75%" and mar["vintage"] == d("2026-09-01")
    assert r["2026-01-01"]["source_note"] == "n" and len(r) == 11


def test_briefing_reports_missing_and_wrong(spark, config_and_articles):
    config, arts = config_and_articles
    broken = [(u, h.replace("45.15%", "44%")) for u, h in arts if not u.endswith("9010")]
    run = briefing.run_briefing(config, spark.createDataFrame(broken, "url string, html string"))
    bad = {(r["obs_month"].isoformat(), r["field"]): r["reason"] for r in run["verification"].filter("NOT ok").collect()}
    assert bad[("2026-03-01", "hedge_ratio_regulatory")] == "value_absent"
    assert bad[("2026-07-01", "hedge_ratio_regulatory")] == "text_absent"
    assert bad[("2026-07-01", "hedge_cs_share_note")] == "text_absent"
    assert len(bad) == 3 and run["gate"].first()["status"] == "fail"


def test_reserve_tie_to_prior_month(spark):
    df = spark.createDataFrame(
        [("s", d("2025-12-01"), 613700.0, None, None), ("s", d("2026-02-01"), 625900.0, 100.0, "prev_month"), ("s", d("2026-03-01"), 621400.0, -6300.0, "prev_month")],
        "e string, m date, v double, ch double, basis string",
    )
    c = reconcile(prior_period_rows(df, ["e"], "m", "v", "basis"), [Check("t", F.col("ref_value") + F.col("ch"), F.col("v"))], ["m"])
    assert [(r["m"], r["passed"]) for r in c.collect()] == [(d("2026-03-01"), True)]


# ------------------------------------------------------------- files


def test_source_list_quarantine(spark, tmp_path):
    p = tmp_path / "list.tsv"
    p.write_text("# comment\n\nh1\t1\thttps://a\t\tfirst\nh2\t2\thttps://b\t403\nh3\t3\thttps://c\nbroken\tline\n", encoding="utf-8")
    good, bad = landed.read_source_list(spark, str(p))
    assert [tuple(r) for r in good.orderBy("host").collect()] == [
        ("h1", 1, "https://a", None, "first"), ("h2", 2, "https://b", 403, ""), ("h3", 3, "https://c", None, "")
    ]
    assert [r["value"] for r in bad.collect()] == ["broken\tline"]


def test_scan_files_and_admissibility(spark, tmp_path):
    (tmp_path / "20200428.html").write_text("x" * 6000, encoding="utf-8")
    (tmp_path / "short.html").write_text("字", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("ignored", encoding="utf-8")
    df = landed.admissibility(landed.scan_files(spark, str(tmp_path)), "html", landed.ARTICLE_MIN_BYTES)
    got = {r["doc_id"]: (r["n_bytes"], r["ok"], r["note"]) for r in df.collect()}
    assert got == {"20200428": (6000, True, None), "short": (3, False, "inadmissible_response")}


def test_line_items_round_trip(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("obs_month,assets,debt\n2025-01,10.5,\n2025-02,11,3\n", encoding="utf-8")
    long = landed.read_line_items(spark, str(p), ["obs_month"], ["assets", "debt"])
    assert long.count() == 3
    wide = landed.to_wide(long, ["obs_month"], ["assets", "debt"]).orderBy("obs_month").collect()
    assert [tuple(r) for r in wide] == [("2025-01", D("10.5"), None), ("2025-02", D(11), D(3))]


def test_csv_sink_sorts_columns(spark, tmp_path):
    df = spark.createDataFrame([(D("2.5000"), "x", D("44700"))], "z decimal(20,4), b string, a decimal(20,4)")
    assert sinks.write_csv(df, str(tmp_path / "o")) == ["a", "b", "z"]
    lines = {r["value"] for r in spark.read.text(str(tmp_path / "o")).collect()}
    assert lines == {"a,b,z", "44700,x,2.5"}  # every part file starts with the header


def test_report_and_frames(spark, tmp_path):
    rows = spark.createDataFrame([(d("2025-01-01"), ["w1"]), (d("2025-02-01"), [])], "m date, warnings array<string>")
    checks = reconcile(spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "l double, r double"), [Check("c", F.col("l"), F.col("r"))])
    rep = sinks.run_report("r", run_gate(checks), checks, rows, "m", "warnings")
    sinks.write_report(rep, str(tmp_path / "rep"))
    obj = json.loads(spark.read.text(str(tmp_path / "rep")).first()["value"])
    assert (obj["status"], obj["n_rows"], obj["first_period"]) == ("fail", 2, "2025-01-01")
    assert obj["checks"][0]["checks_failed"] == 1 and list(obj["warnings"]) == ["2025-01-01"]

    pts = spark.createDataFrame([("s", d("2025-02-01"), 2.0), ("s", d("2025-01-01"), 1.0), ("s", d("2025-03-01"), None)], "k string, m date, v double")
    frame = json.loads(sinks.frame_export(pts, "k", F.col("m"), F.col("v")).first()["frame"])
    assert frame == {"index": ["2025-01-01", "2025-02-01"], "columns": {"value": [1.0, 2.0]}}


def test_published_table_is_partitioned(spark, tmp_path):
    df = sinks.common_schema(
        spark.createDataFrame([("a", d("2025-01-01"), 1.0), (None, d("2025-01-01"), 2.0)], "entity_id string, obs_date date, value double"),
        series_id="1", unit="ratio",
    ).withColumn("vintage", F.lit("2025-02-01"))
    sinks.write_published(df, str(tmp_path / "pub"))
    back = spark.read.parquet(str(tmp_path / "pub")).filter("series_id = 1")
    assert back.count() == 2 and "series_id=1" in "".join(x.name for x in (tmp_path / "pub").iterdir())


def test_every_indicator_has_a_vintage(spark, sf_dir):
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n in ("ind_residual", "ind_ratio_differential", "ind_strengthening_reserve", "derived_series")]
    for n in names:
        df = __spark_entry__.queries()[n](spark, sf_dir)
        assert df.filter("vintage IS NULL OR basis IS NULL").count() == 0, n


def test_merged_provenance_does_not_depend_on_the_order(spark):
    from obslake.operators import provenance as pv

    rows = [(d("2025-01-01"), d("2025-03-01"), "disclosed", "a; b"), (d("2025-02-01"), None, "estimated", "c"), (None, d("2025-02-01"), None, None)]
    df = spark.createDataFrame(rows, "vintage date, retrieved_at date, basis string, sources string").withColumn("p", pv.of_columns())
    want = (d("2025-02-01"), d("2025-03-01"), "estimated", "a; b; c")
    assert tuple(df.agg(pv.merge_rows("p").alias("p")).select(*pv.told("p")).head()) == want
    one = spark.createDataFrame([(*rows[0], *rows[1])], "a date, b date, c string, d string, e date, f date, g string, h string")
    x, y = pv.leg(*[F.col(c) for c in "abcd"]), pv.leg(*[F.col(c) for c in "efgh"])
    assert all(tuple(one.select(*pv.told(pv.merge(*legs))).head()) == want for legs in ((x, y), (y, x), (x, pv.leg(), y)))


def test_cross_market_rows_hold_every_region(spark, tmp_path):
    """A region with a new name, or none, keeps its rows."""
    import shutil

    for name in ("region", "nation", "customer", "orders", "lineitem", "supplier"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path)
    region = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    renamed = F.when(F.col("r_name") == "ASIA", "OCEANIA").when(F.col("r_name") != "EUROPE", F.col("r_name"))
    region.withColumn("r_name", renamed).write.mode("overwrite").parquet(str(tmp_path / "region2"))
    (tmp_path / "region.parquet").unlink()
    (tmp_path / "region2").rename(tmp_path / "region.parquet")
    import __spark_entry__

    query = __spark_entry__.queries()["cross_market_rows"]
    total = lambda sf: query(spark, str(sf)).agg(F.round(F.sum("value"), 2)).first()[0]
    assert {"OCEANIA", None} <= {r["market"] for r in query(spark, str(tmp_path)).select("market").distinct().collect()}
    assert total(tmp_path) == total("/root/testdata/sf0.001")


def test_panel_sums_by_nation_and_not_by_supplier(spark, sf_dir):
    from obslake.plans.proxies import panel
    from obslake.sources.landed import Tables

    plan = panel(Tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    sums = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert len(sums) == 1 and "n_name" in sums[0] and "l_suppkey" not in sums[0].split("]")[0]
