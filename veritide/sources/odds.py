"""Odds and results from files of several layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.functions.odds import american_to_decimal
from veritide.functions.parse import first_present, match_date, year_corrected


def odds_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files of drifting headers under common names, all columns text; other columns stay as they are.

    Files of one header are read together; their layouts are unioned by name.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        head = spark.read.option("header", True).csv(p).columns
        by_header.setdefault(tuple(head), []).append(p)
    frames = [spark.read.option("header", True).csv(ps) for ps in by_header.values()]
    df = frames[0]
    for other in frames[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    return with_identity(df)


NAMES = {"home_team": ("HomeTeam", "Home"), "away_team": ("AwayTeam", "Away"), "home_goals": ("FTHG", "HG"), "away_goals": ("FTAG", "AG"), "competition": ("Div", "League"), "date_raw": ("Date",)}


def with_identity(df: DataFrame, since: str | None = None) -> DataFrame:
    """Adds the common names, match_date and skip_reason: missing_identity, invalid_date, before_since or null."""
    have = set(df.columns)
    named = df.withColumns({k: first_present(*(F.col(f"`{v}`") for v in vs if v in have)) if any(v in have for v in vs) else F.lit(None).cast("string") for k, vs in NAMES.items()})
    dated = named.withColumn("match_date", match_date("date_raw"))
    skip = F.when(F.col("home_team").isNull() | F.col("away_team").isNull(), "missing_identity").when(F.col("match_date").isNull(), "invalid_date")
    if since:
        skip = skip.when(F.col("match_date") < F.lit(since), "before_since")
    goals = {c: F.col(c).try_cast("int") for c in ("home_goals", "away_goals")}
    return dated.withColumns(goals | {"skip_reason": skip})


def tournament_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, events): a result counts if `Finished` says 90 minutes; other finished rows give a failure event."""
    regular = F.col("Finished") == "90 minutes"
    rows = df.withColumns({"result_eligible": F.coalesce(regular, F.lit(False)), "result_scope": F.when(regular, "regular_time_90").otherwise("ambiguous")})
    events = rows.where(~F.col("result_eligible")).select(F.lit("result_scope_ambiguous").alias("event_type"), F.lit("failed").alias("status"), F.to_json(F.struct(F.col("fixture_key").alias("fixture_record_id"))).alias("details"))
    return rows, events


def odds_history(df: DataFrame, zone_max_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(points, quarantined) of nested histories: match_id, kickoff, markets[market, rows[bookmaker, period, groups[history[timestamp, odds], opening]]].

    The opening point joins the history; years are corrected against kickoff, American odds become decimal.
    """
    r = df.select("match_id", "kickoff", F.explode_outer("markets").alias("m")).select("match_id", "kickoff", "m.market", F.explode_outer("m.rows").alias("r"))
    g = r.select("match_id", "kickoff", "market", "r.bookmaker", "r.period", F.posexplode_outer("r.groups").alias("group", "g"))
    points = F.array_union(F.coalesce("g.history", F.array()), F.when(F.col("g.opening").isNotNull(), F.array("g.opening")).otherwise(F.array()))
    p = g.select("match_id", "kickoff", "market", "bookmaker", "period", "group", F.explode(points).alias("p"))
    fixed = p.select("match_id", "market", "bookmaker", "period", "group", year_corrected("p.timestamp", "kickoff", zone_max_days).alias("t"), american_to_decimal("p.odds").alias("odds"))
    out = fixed.select("match_id", "market", "bookmaker", "period", "group", F.col("t.ts").alias("at"), F.col("t.status").alias("time_status"), "odds")
    bad = (F.col("time_status") == "quarantined") | F.col("odds").isNull()
    return out.where(~bad), out.where(bad)


def manual_results(df: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(imported, conflicts, rejected) of manual results: numeric id, goals of 0 or more; a differing stored score is a conflict, never overwritten."""
    t = df.select(F.col("fixture_id").try_cast("long").alias("fixture_id"), F.col("home_goals").try_cast("int").alias("home_goals"), F.col("away_goals").try_cast("int").alias("away_goals"))
    ok = F.coalesce(F.col("fixture_id").isNotNull() & (F.col("home_goals") >= 0) & (F.col("away_goals") >= 0), F.lit(False))
    e = existing.select("fixture_id", F.struct("home_goals", "away_goals").alias("_old"))
    j = t.where(ok).join(e, "fixture_id", "left")
    differs = F.col("_old").isNotNull() & (F.col("_old") != F.struct("home_goals", "away_goals"))
    return j.where(F.col("_old").isNull()).drop("_old"), j.where(differs).drop("_old"), t.where(~ok)


#: Names of the row list and of the page count in feeds.
ROW_KEYS, PAGE_KEYS = ("matchResult", "list", "rows", "data"), ("pages", "totalPages", "pageCount", "total_pages")


def feed_rows(df: DataFrame, body: str = "body", row: str = "map<string,string>") -> DataFrame:
    """Rows under the first of several keys, at the top or under value; total_pages is 1 at least."""
    at = [f"$.{p}{k}" for p in ("", "value.") for k in ROW_KEYS]
    rows = F.coalesce(*(F.from_json(F.get_json_object(body, path), f"array<{row}>") for path in at))
    pages = F.greatest(F.coalesce(*(F.get_json_object(body, f"$.{p}{k}").try_cast("int") for p in ("", "value.") for k in PAGE_KEYS), F.lit(1)), F.lit(1))
    return df.select("*", pages.alias("total_pages"), F.explode_outer(rows).alias("row"))


def catalogue(spark: SparkSession, leagues: dict[str, str], seasons: list[str], extra: dict[str, str]) -> DataFrame:
    """Registered assets: a season file of each league and season, and extra files."""
    rows = [(f"{code}-{s}", "season_csv", name, s) for code, name in leagues.items() for s in seasons] + [(code, "extra_csv", name, None) for code, name in extra.items()]
    return spark.createDataFrame(rows, "asset_id string, kind string, competition string, season string")
