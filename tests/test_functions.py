import hashlib

import pytest
from pyspark.sql import functions as F

from veritide.functions import ids, odds, parse


def one(spark, *cols):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first()


@pytest.mark.parametrize(
    ("raw", "line", "movement", "error"),
    [("平手", 0.0, None, None), ("平手/半球", -0.25, None, None), ("半球/一球 升", -0.75, "up", None), ("受一球/球半 降", 1.25, "down", None), ("", None, None, "missing"), (None, None, None, "missing"), ("-0.75", -0.75, None, None), ("11", None, None, "handicap_line_out_of_range"), ("甲", None, None, "unknown_handicap_line")],
)
def test_handicap_line(spark, raw, line, movement, error):
    got = one(spark, parse.handicap_line(F.lit(raw).cast("string")))[0]
    assert (got["line"], got["movement"], got["error"]) == (line, movement, error)


@pytest.mark.parametrize(("raw", "line", "error"), [("2", 2.0, None), ("2/2.5", 2.25, None), ("2.5/3", 2.75, None), ("1/3", None, "invalid_total_split"), ("x", None, "unknown_total_line"), ("21", None, "total_line_out_of_range"), (" ", None, "missing")])
def test_total_line(spark, raw, line, error):
    got = one(spark, parse.total_line(F.lit(raw)))[0]
    assert (got["line"], got["error"]) == (line, error)


def test_strict_timestamp_wants_a_zone(spark):
    got = one(spark, *(parse.strict_timestamp(F.lit(x)) for x in ("2026-01-01T10:00:00+08:00", "2026-01-01T10:00:00", "2026-01-01 02:00:00Z", "nonsense")))
    assert got[0] == got[2] and got[0].hour == 2 and got[1] is None and got[3] is None


def test_decimal_text(spark):
    got = one(spark, *(parse.decimal_text(F.lit(x), True) for x in ("2,000", "12.5%", "", "abc")))
    assert [(None if g["value"] is None else float(g["value"]), g["bad"]) for g in got] == [(2000.0, False), (12.5, False), (None, False), (None, True)]


def test_canonical_decimal(spark):
    assert list(one(spark, *(parse.canonical_decimal(F.lit(x)) for x in ("1.500", "0.0", "2", "10")))) == ["1.5", "0", "2", "10"]


def test_names_and_roles(spark):
    got = one(spark, parse.canonical_name(F.lit("  Ａ  b ")), parse.canonical_name(F.lit("Ａ b"), True), parse.source_role(F.lit("平均值")), parse.source_role(F.lit(" ")), parse.source_role(F.lit("竞彩官方")), parse.source_role(F.lit("x")))
    assert list(got) == ["A b", "ab", "summary", "unknown", "official", "bookmaker"]


def test_years(spark):
    k = F.lit("2026-01-02 12:00:00").cast("timestamp")
    got = one(spark, parse.month_day_time(F.lit("12-31 10:00"), k), parse.month_day_time(F.lit("01-01 10:00"), k), parse.year_corrected(F.lit("2026-12-30 00:00:00").cast("timestamp"), k), parse.year_corrected(F.lit("2026-06-01 00:00:00").cast("timestamp"), k), parse.year_corrected(F.lit("2026-01-01 00:00:00").cast("timestamp"), k))
    assert got[0].year == 2025 and got[1].year == 2026
    assert [g["status"] for g in got[2:]] == ["year_corrected", "quarantined", "validated"] and got[2]["ts"].year == 2025


def test_dates_and_scores(spark):
    got = one(spark, *(parse.match_date(F.lit(x)) for x in ("05/03/2026", "05/03/26", "2026-03-05", "12/31/2026")), *(parse.score_text(F.lit(x)) for x in ("2:1", "2-1", "-1:-1", "VS")))
    assert [d.isoformat() for d in got[:4]] == ["2026-03-05", "2026-03-05", "2026-03-05", "2026-12-31"]
    assert [None if s is None else (s["home"], s["away"]) for s in got[4:]] == [(2, 1), (2, 1), None, None]


def test_export_rows_and_quality(spark):
    got = one(spark, parse.export_rows(F.lit("a|b$c|d$")))[0]
    assert [(r["row_index"], r["cells"]) for r in got] == [(0, ["a", "b"]), (1, ["c", "d"])]
    bad = spark.createDataFrame([("x�",), ("ok",), (" ",)], "t string").select(parse.text_quality("t").alias("q")).collect()
    assert [r["q"] for r in bad] == [["replacement_character:t"], [], ["blank:t"]]


def test_local_days(spark):
    got = one(spark, parse.local_day(F.lit("2026-01-01 17:00:00").cast("timestamp")), parse.day_bounds(F.lit("2026-01-02").cast("date")))
    assert got[0].isoformat() == "2026-01-02" and got[1]["start"].isoformat() == "2026-01-01T16:00:00"


def test_devig_rules(spark):
    got = one(spark, *(odds.devig(F.lit(a), F.lit(3.0), F.lit(4.0), rule=r) for a in (2.0, 0.5) for r in ("above_one", "positive", "finite")))
    assert [g is None for g in got] == [False, False, False, True, False, False]
    assert sum(got[0]["p"]) == pytest.approx(1) and got[0]["margin"] == pytest.approx(1 / 2 + 1 / 3 + 1 / 4)
    assert one(spark, odds.devig(F.lit(0.0), F.lit(3.0), F.lit(4.0), rule="finite"))[0] is None


def test_prices_and_ties(spark):
    got = one(spark, odds.american_to_decimal(F.lit(600)), odds.american_to_decimal(F.lit(-500)), odds.american_to_decimal(F.lit(0)), odds.favourite(F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2))), odds.devig_pair(F.lit(0.9), F.lit(0.9)), odds.devig_pair(F.lit(0.0), F.lit(0.9)))
    assert got[0] == 7.0 and got[1] == 1.2 and got[2] is None and got[3] == 0 and got[4] == [0.5, 0.5] and got[5] is None


def test_bins(spark):
    got = one(spark, *(odds.probability_bin(F.lit(x)) for x in (0.399, 0.40, 0.55)), *(odds.gap_bin(F.lit(x)) for x in (0.05, 0.2)), *(odds.line_bucket(F.lit(x)) for x in (-0.25, 0.0, 0.5, 1.0, 1.25)), *(odds.total_bucket(F.lit(x)) for x in (2.0, 2.25, 2.75)))
    assert list(got) == ["<0.40", "0.40-0.45", ">=0.55", "0.05-0.10", ">=0.20", "unsupported", "level", "shallow", "medium", "deep", "<=2.00", "2.25", ">=2.75"]


def test_maturity_and_presentation(spark):
    got = one(spark, *(odds.maturity(F.lit(n), F.lit(d)) for n, d in ((29, 90), (30, 0), (200, 89), (200, 90))), odds.presented(F.lit("downgrade"), F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)), F.lit("high")), odds.presented(F.lit("abstain"), F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)), F.lit("high")))
    assert list(got[:4]) == ["unvalidated", "provisional", "provisional", "sample_gate_met"]
    assert (got[4]["direction"], got[4]["confidence"]) == ("away", "low") and (got[5]["direction"], got[5]["confidence"]) == (None, "observation_only")


def test_history_row_of_a_drawn_favourite(spark):
    f = lambda *x: F.array(*map(F.lit, x))
    h = one(spark, odds.history_row(f(0.2, 0.6, 0.2), F.lit(-0.5), F.lit(0.25), F.lit(0.1), F.lit(0.2), F.lit(2.5)), odds.history_row(f(0.6, 0.2, 0.2), F.lit(-0.5), F.lit(0.25), F.lit(0.1), F.lit(0.2), F.lit(2.5)))
    assert h[0]["draw_is_top"] and h[0]["favourite_line"] is None and h[0]["directional"] == "home"
    assert h[1]["favourite_line"] == 0.5 and h[1]["favourite_line_delta"] == -0.25 and h[1]["favourite_odds_delta"] == 0.1 and h[1]["line_bucket"] == "shallow"


def test_ids(spark):
    got = one(spark, ids.stable_id("k", F.lit("a"), F.lit(None)))[0]
    assert got == hashlib.sha256(b"k|a|None").hexdigest()
    df = spark.createDataFrame([("b",), ("a",)], "m string")
    assert df.agg(ids.set_hash("m")).first()[0] == hashlib.sha256(b"a\nb").hexdigest()
    assert ids.dataset_hash(df, "m").first() == ids.dataset_hash(df.repartition(3), "m").first()


def test_update_class(spark):
    rows = [("a", "b", "a", "b"), ("a", "b", "a", "c"), ("a", "b", "x", "y"), ("a", "b", None, "b")]
    df = spark.createDataFrame(rows, "c1 string, c2 string, p1 string, p2 string").select(ids.update_class(["c1", "c2"], ["p1", "p2"]).alias("u"))
    assert [r["u"]["status"] for r in df.collect()] == ["unchanged", "partial_update", "full_update", "not_available"]
