"""Strict parsing of raw text columns. Unreadable input is null or has an error code, never a guess."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Names of handicap lines and the lines they stand for.
LINE_NAMES = {"平手": 0.0, "半球": 0.5, "一球": 1.0, "球半": 1.5, "两球": 2.0, "两球半": 2.5, "三球": 3.0, "三球半": 3.5, "四球": 4.0, "四球半": 4.5, "五球": 5.0}
#: Source names that are no bookmakers.
SUMMARY_NAMES, OFFICIAL_NAME = ("最高值", "最低值", "平均值", "离散值"), "竞彩官方"

ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: str | Column) -> Column:
    return F.nullif(F.trim(_c(x)), F.lit(""))


def first_present(*names: str | Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*map(blank_to_null, names))


def strict_timestamp(x: str | Column) -> Column:
    """A timestamp with a zone; null for naive or malformed text."""
    x = F.trim(_c(x))
    return F.when(x.rlike(ZONED), F.try_to_timestamp(x))


def event_time(*names: str) -> Column:
    """The first readable of several time columns."""
    return F.coalesce(*(strict_timestamp(n) for n in names))


def decimal_text(x: str | Column, percent: bool = False) -> Column:
    """struct(value decimal(18,8), bad): thousands commas and, if asked, a percent sign are dropped; bad marks text that is no number."""
    t = F.regexp_replace(F.trim(_c(x)), ",", "")
    t = F.nullif(F.regexp_replace(t, "%$", "") if percent else t, F.lit(""))
    v = t.try_cast("decimal(18,8)")
    return F.struct(v.alias("value"), (t.isNotNull() & v.isNull()).alias("bad"))


def canonical_decimal(x: str | Column) -> Column:
    """A decimal as text without trailing zeros; zero is '0'."""
    t = F.regexp_replace(F.regexp_replace(_c(x).cast("decimal(38,10)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(t == "-0", "0").otherwise(t)


def source_role(name: str | Column) -> Column:
    name = F.trim(_c(name))
    return F.when(name.isNull() | (name == ""), "unknown").when(name.isin(*SUMMARY_NAMES), "summary").when(name == OFFICIAL_NAME, "official").otherwise("bookmaker")


def handicap_line(x: str | Column) -> Column:
    """struct(line, movement, error) of a handicap text.

    A trailing 升 or 降 is the movement, a leading 受 receives the line (positive), else it is given
    (negative); a/b is the mean of both names. Numbers from -10 to 10 are lines themselves.
    """
    raw = F.regexp_replace(F.trim(_c(x)), r"\s+", "")
    movement = F.when(raw.endswith("升"), "up").when(raw.endswith("降"), "down")
    body = F.regexp_replace(raw, "[升降]$", "")
    number = body.try_cast("double")
    receiving = body.startswith("受")
    names = F.create_map(*(F.lit(v) for pair in LINE_NAMES.items() for v in pair))
    parts = F.transform(F.split(F.regexp_replace(body, "^受", ""), "/"), lambda p: F.try_element_at(names, p))
    known = ~F.exists(parts, lambda p: p.isNull()) & (F.size(parts) <= 2)
    mean = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / F.size(parts)
    signed = F.when(mean == 0, F.lit(0.0)).when(receiving, mean).otherwise(-mean)
    error = (
        F.when(raw.isNull() | (body == ""), "missing").when(number.isNotNull() & (F.abs(number) > 10), "handicap_line_out_of_range").when(number.isNull() & ~known, "unknown_handicap_line")
    )
    return F.struct(F.when(error.isNull(), F.coalesce(number, signed)).alias("line"), F.when(error.isNull(), movement).alias("movement"), error.alias("error"))


def total_line(x: str | Column) -> Column:
    """struct(line, error) of x or x/y, whose parts differ by exactly 0.5; the line lies in [0, 20]."""
    raw = F.regexp_replace(F.trim(_c(x)), r"\s+", "")
    parts = F.transform(F.split(raw, "/"), lambda p: p.try_cast("double"))
    n = F.size(parts)
    line = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / n
    error = (
        F.when(raw.isNull() | (raw == ""), "missing")
        .when((n > 2) | F.exists(parts, lambda p: p.isNull()), "unknown_total_line")
        .when((n == 2) & (F.abs(F.get(parts, F.lit(1)) - F.get(parts, F.lit(0))) != 0.5), "invalid_total_split")
        .when((line < 0) | (line > 20), "total_line_out_of_range")
    )
    return F.struct(F.when(error.isNull(), line).alias("line"), error.alias("error"))


@F.pandas_udf(StringType())
def _nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: s if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def _nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: s if s is None else unicodedata.normalize("NFC", s))


def bookmaker_name(x: str | Column) -> Column:
    """NFC, trimmed, inner white space (of any kind) collapsed. ASCII stays in the JVM."""
    x = _c(x).cast("string")
    plain = F.when(x.rlike(r"^[\x00-\x7f]*$"), x).otherwise(_nfc(F.when(~x.rlike(r"^[\x00-\x7f]*$"), x)))
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def canonical_name(x: str | Column, match: bool = False) -> Column:
    """NFKC, trimmed, inner white space collapsed; for matching also lower case and without white space. ASCII stays in the JVM."""
    x = _c(x)
    plain = F.when(x.rlike(r"^[\x00-\x7f]*$"), x).otherwise(_nfkc(F.when(~x.rlike(r"^[\x00-\x7f]*$"), x)))
    return F.lower(F.regexp_replace(plain, r"\s+", "")) if match else F.regexp_replace(F.trim(plain), r"\s+", " ")


def month_day_time(x: str | Column, kickoff: str | Column, zone: str = "UTC") -> Column:
    """MM-DD HH:MM in the kickoff's year, or the year before if that lies over a day after kickoff."""
    x, kickoff = _c(x), _c(kickoff)
    year = F.year(F.from_utc_timestamp(kickoff, zone))
    at = lambda y: F.to_utc_timestamp(F.try_to_timestamp(F.concat(y.cast("string"), F.lit("-"), x), F.lit("yyyy-MM-dd HH:mm")), zone)
    return F.when(at(year) > kickoff + F.expr("INTERVAL 1 DAY"), at(year - 1)).otherwise(at(year))


def year_corrected(ts: str | Column, kickoff: str | Column, max_age_days: int = 30) -> Column:
    """struct(ts, status) with the year of kickoff or the one before that gives the least age in [0, max]; validated, year_corrected or quarantined. A year that lacks the day (29 February) gives none."""
    ts, kickoff = _c(ts), _c(kickoff)
    tries = [F.try_make_timestamp(F.year(kickoff) - k, F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.second(ts)) for k in (0, 1)]
    aged = F.array(*(F.struct((F.unix_timestamp(kickoff) - F.unix_timestamp(t)).alias("age"), t.alias("ts")) for t in tries))
    best = F.array_min(F.filter(aged, lambda a: (a["age"] >= 0) & (a["age"] <= max_age_days * 86400)))
    return F.struct(best["ts"].alias("ts"), F.when(best.isNull(), "quarantined").when(best["ts"] == ts, "validated").otherwise("year_corrected").alias("status"))


def match_date(x: str | Column) -> Column:
    """d/m/Y, d/m/y, Y-m-d, m/d/Y in this order."""
    x = F.trim(_c(x))
    tries = ((r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))
    return F.coalesce(*(F.when(x.rlike(p), F.to_date(F.try_to_timestamp(x, F.lit(f)))) for p, f in tries))


def score_text(x: str | Column) -> Column:
    """struct(home, away) of 'n:m' or 'n-m'; null for anything else, such as -1:-1 or VS."""
    x = F.trim(F.split(_c(x), ",")[0])
    ok = x.rlike(r"^\d+\s*[:-]\s*\d+$")
    return F.when(ok, F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("home"), F.regexp_extract(x, r"(\d+)$", 1).cast("int").alias("away")))


def cancelled(x: str | Column) -> Column:
    """True, false, or null where the text says neither."""
    x = F.lower(F.trim(_c(x).cast("string")))
    return F.when(x.isin("1", "true", "yes", "y"), True).when(x.isin("0", "false", "no", "n"), False)


def export_rows(body: str | Column) -> Column:
    """Rows of '$'-separated text with their '|'-separated cells: array of struct(row_index, cells)."""
    rows = F.split(_c(body), r"\$")
    return F.transform(F.filter(F.transform(rows, lambda r, i: F.struct(i.alias("row_index"), F.split(r, r"\|").alias("cells"), r.alias("raw"))), lambda s: F.trim(s["raw"]) != ""), lambda s: s.dropFields("raw"))


def text_quality(*names: str) -> Column:
    """Codes of decoding trouble in text columns."""
    checks = []
    for n in names:
        c = F.col(n)
        checks += [F.when(c.contains("�"), f"replacement_character:{n}"), F.when(c.rlike("Ã.|Â.|â€"), f"mojibake:{n}"), F.when(F.trim(c) == "", f"blank:{n}")]
    return F.array_compact(F.array(*checks))


def local_day(ts: str | Column, zone: str = "Asia/Shanghai") -> Column:
    """The calendar day of a UTC timestamp in a zone."""
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))


def day_bounds(day: str | Column, zone: str = "Asia/Shanghai") -> Column:
    """struct(start, end) in UTC of a local calendar day."""
    start = _c(day).cast("timestamp")
    return F.struct(F.to_utc_timestamp(start, zone).alias("start"), F.to_utc_timestamp(start + F.expr("INTERVAL 1 DAY"), zone).alias("end"))


def any_of(*checks: Column) -> Column:
    return reduce(lambda a, b: a | b, checks, F.lit(False))
