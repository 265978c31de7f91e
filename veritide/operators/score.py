"""Scores of probability forecasts and the statistics around them."""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.functions.odds import favourite
from veritide.operators.staged import staged


def row_scores(p: str = "p", actual: str = "actual") -> dict[str, Column]:
    """log_loss, brier, rps, top (greatest probability) and hit of one forecast over three outcomes."""
    q, y = F.col(p), F.col(actual)
    hit = [(y == i).cast("double") for i in range(3)]
    return {
        "log_loss": -F.ln(F.greatest(F.get(q, y), F.lit(1e-15))),
        "brier": sum(((q[i] - hit[i]) * (q[i] - hit[i]) for i in range(1, 3)), (q[0] - hit[0]) * (q[0] - hit[0])),
        "rps": ((q[0] - hit[0]) * (q[0] - hit[0]) + (q[0] + q[1] - hit[0] - hit[1]) * (q[0] + q[1] - hit[0] - hit[1])) / 2,
        "top": F.array_max(q),
        "hit": (favourite(q) == y).cast("int"),
    }


def scored(df: DataFrame, p: str = "p", actual: str = "actual") -> DataFrame:
    return df.withColumns(row_scores(p, actual))


def metrics(least: int = 100) -> list[Column]:
    """Aggregates over scored rows."""
    return [
        F.count("*").alias("sample_size"),
        F.avg("log_loss").alias("log_loss"),
        F.avg("brier").alias("brier"),
        F.avg("rps").alias("rps"),
        F.avg("hit").alias("accuracy"),
        F.when(F.count("*") >= least, "available").otherwise("insufficient_sample").alias("conclusion"),
    ]


def grouped_metrics(rows: DataFrame, sets: list[tuple[str, ...]], least: int = 100) -> DataFrame:
    """Metrics over grouping sets in one pass; a key that a set leaves out reads 'all'."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    names = ", ".join(f"`{k}`" for k in keys)
    groups = ", ".join("(" + ", ".join(f"`{k}`" for k in s) + ")" for s in sets)
    sums = f"count(*) AS sample_size, avg(log_loss) AS log_loss, avg(brier) AS brier, avg(rps) AS rps, avg(hit) AS accuracy, {', '.join(f'grouping(`{k}`) AS _g{i}' for i, k in enumerate(keys))}"
    got = rows.sparkSession.sql(f"SELECT {names}, {sums} FROM {{rows}} GROUP BY GROUPING SETS ({groups})", rows=rows)
    shown = [F.when(F.col(f"_g{i}") == 1, "all").otherwise(F.col(k).cast("string")).alias(k) for i, k in enumerate(keys)]
    return got.select(*shown, "sample_size", "log_loss", "brier", "rps", "accuracy", F.when(F.col("sample_size") >= least, "available").otherwise("insufficient_sample").alias("conclusion"))


def with_baselines(df: DataFrame, market: str = "p", prior: str | None = None) -> DataFrame:
    """A row for each baseline: uniform, prior if there is one, market."""
    third = F.array(*(F.lit(1 / 3) for _ in range(3)))
    options = [F.struct(F.lit("uniform").alias("baseline"), third.alias("p")), F.struct(F.lit("market").alias("baseline"), F.col(market).alias("p"))]
    if prior:
        options.insert(1, F.struct(F.lit("prior").alias("baseline"), F.col(prior).alias("p")))
    rest = [c for c in df.columns if c not in {market, prior}]
    return df.select(*rest, F.explode(F.array(*options)).alias("_b")).select(*rest, "_b.*")


def full_grid(found: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Also the cells of the grid that no row falls into, with sample_size 0."""
    return grid.join(found, keys, "left").na.fill({"sample_size": 0})


def bucketed(df: DataFrame, groups: list[str], bucket: Column, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name of sums, the sum over a group's rows up to and with this one as <name>, and over the whole group as <name>_all.

    bucket must not decrease with the order. Rows are sorted within buckets only, and what lies before a bucket
    comes from a small table of bucket sums, so a group with a third of all rows is spread over as many
    tasks as it has buckets.
    """
    marked = df.withColumns({"_bucket": bucket, **{f"_v_{n}": c for n, c in sums.items()}})
    per = marked.groupBy(*groups, "_bucket").agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums))
    by = Window.partitionBy(*groups)
    run = by.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)), F.col("_bucket").alias("_edge"), *(F.coalesce(F.sum(f"_t_{n}").over(run), F.lit(0)).alias(f"_b_{n}") for n in sums), *(F.sum(f"_t_{n}").over(by).alias(f"{n}_all") for n in sums))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    on = [marked[g].eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)] + [marked["_bucket"].eqNullSafe(F.col("_edge"))]
    ran = marked.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in sums})
    return ran.join(per, on).select(*df.columns, *((F.col(f"_b_{n}") + F.col(f"_r_{n}")).alias(n) for n in sums), *(f"{n}_all" for n in sums))


def day(at: str) -> Column:
    """A bucket for rows that are ordered by a time."""
    return F.unix_date(F.col(at).cast("date"))


def running_prior(df: DataFrame, groups: list[str], order: list[str], actual: str, counts: Column) -> DataFrame:
    """prior: (1 + earlier outcomes) shares before each row; only rows where `counts` holds are counted. order begins with a date or time."""
    own = [F.when(F.coalesce(counts, F.lit(False)) & (F.col(actual) == k), 1).otherwise(0) for k in range(3)]
    ran = bucketed(df, groups, day(order[0]), order, {f"_c{k}": c for k, c in enumerate(own)})
    seen = [F.col(f"_c{k}") - own[k] + 1 for k in range(3)]
    total = seen[0] + seen[1] + seen[2]
    return ran.select(*df.columns, F.array(*(x / total for x in seen)).alias("prior"))


def calibration_error(rows: DataFrame, groups: list[str], confidence: str = "top", hit: str = "hit", bins: int = 10, buckets: int = 4096) -> DataFrame:
    """(groups, ece, n): equal-count bins [i*n//b, (i+1)*n//b) of rows ordered by confidence and hit. Confidence lies in 0 to 1.

    Rows equal in both are counted before they are ordered, and a count is divided among the bins it reaches into. So a constant forecast is two counts.
    """
    counted = rows.groupBy(*groups, confidence, hit).agg(F.count("*").alias("_k"))
    ran = bucketed(counted, groups, F.floor(F.col(confidence) * buckets), [confidence, hit], {"_end": F.col("_k")})
    n, start = F.col("_end_all"), F.col("_end") - F.col("_k")
    b = F.least(F.lit(bins), n)
    at = lambda rank: F.floor((b * (rank + 1) - 1) / n)  # noqa: E731  the bin of a rank from 0
    edge = lambda i: F.floor(i * n / b)
    binned = ran.withColumn("_bin", F.explode(F.sequence(at(start), at(F.col("_end") - 1))))
    share = F.least(F.col("_end"), edge(F.col("_bin") + 1)) - F.greatest(start, edge(F.col("_bin")))
    per = binned.withColumn("_m", share).groupBy(*groups, "_bin").agg(F.sum("_m").alias("_m"), (F.sum(F.col("_m") * F.col(confidence)) / F.sum("_m")).alias("_c"), (F.sum(F.col("_m") * F.col(hit)) / F.sum("_m")).alias("_h"), F.first("_end_all").alias("_n"))
    return per.groupBy(*groups).agg(F.sum(F.col("_m") / F.col("_n") * F.abs(F.col("_c") - F.col("_h"))).alias("ece"), F.sum("_m").alias("n"))


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]], buckets: int = 1024, rounds: int = 2) -> DataFrame:
    """(keys, n, least, most, one column for each name of ranks): the value at that rank (from 0, as a function of n) among a group's sorted values. Nulls don't count.

    Distributed selection for all groups and ranks at once: distinct values are counted, then `rounds` times put into buckets between the least and the greatest
    value that a rank can have, of which only the one that holds the rank goes on. What is left, about buckets ** -rounds of a group, is sorted.
    """
    groups = [F.col(k) for k in keys] or [F.lit(0)]
    named = [f"_g{i}" for i in range(len(groups))]
    rows = df.where(F.col(value).isNotNull()).select(*(k.alias(g) for k, g in zip(groups, named, strict=True)), F.col(value).alias("_v"))
    counted = staged(rows.groupBy(*named, "_v").agg(F.count("*").alias("_c")))
    whole = counted.groupBy(*named).agg(F.sum("_c").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"))
    asked = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()))).alias("_a")
    state = whole.select(*named, "least", "most", asked).select(*(F.col(g).alias(f"s{g}") for g in named), "_a.*", F.col("least").alias("lo"), F.col("most").alias("hi"))
    by = [*(f"s{g}" for g in named), "name"]
    on = lambda left: [left[g].eqNullSafe(F.col(f"s{g}")) for g in named] + [F.col("_v").between(F.col("lo"), F.col("hi"))]
    for last in [False] * rounds + [True]:
        near = counted.join(state, on(counted))
        if last:
            cells = near.groupBy(*by, "rank", F.col("_v").alias("_at")).agg(F.sum("_c").alias("_k"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        else:
            width = (F.col("hi") - F.col("lo")).cast("double")
            place = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("lo")).cast("double") / width * buckets), F.lit(buckets - 1))).otherwise(0)
            cells = near.groupBy(*by, "rank", place.alias("_at")).agg(F.sum("_c").alias("_k"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        end = F.sum("_k").over(Window.partitionBy(*by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
        state = cells.withColumn("_end", end).where((F.col("rank") < F.col("_end")) & (F.col("rank") >= F.col("_end") - F.col("_k"))).select(*by, (F.col("rank") - F.col("_end") + F.col("_k")).alias("rank"), "lo", "hi")
    found = state.groupBy(*by[:-1]).agg(*(F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in ranks))
    j = whole.join(found, [whole[g].eqNullSafe(found[f"s{g}"]) for g in named])
    return j.select(*(F.col(g).alias(k) for g, k in zip(named, keys, strict=False)), "n", "least", "most", *ranks)


#: Ranks of the two values whose mean is the median.
MIDDLE = {"_below": lambda n: F.floor((n - 1) / 2), "_above": lambda n: F.floor(n / 2)}


def fraction_rank(fraction: float) -> Callable[[Column], Column]:
    """The rank int(fraction * (n - 1))."""
    return lambda n: F.floor(fraction * (n - 1))


def wilson(successes: str | Column, count: str | Column, confidence: float = 0.90) -> Column:
    """struct(lower, upper) of the Wilson interval; null without trials."""
    s, n = (F.col(x) if isinstance(x, str) else x for x in (successes, count))
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    rate, zz = s / F.nullif(n, F.lit(0)), z * z
    centre, den = rate + zz / (2 * n), 1 + zz / n
    margin = z * F.sqrt(rate * (1 - rate) / n + zz / (4 * n * n))
    return F.when(n > 0, F.struct(F.greatest(F.lit(0.0), (centre - margin) / den).alias("lower"), F.least(F.lit(1.0), (centre + margin) / den).alias("upper")))


def holm(df: DataFrame, p: str, key: str, groups: list[str] | None = None) -> DataFrame:
    """adjusted: Holm's step-down p-values of a family of tests."""
    w = Window.partitionBy(*(groups or []))
    ordered = w.orderBy(p, key)
    step = F.least(F.lit(1.0), (F.count("*").over(w) - F.row_number().over(ordered) + 1) * F.col(p))
    return df.withColumn("_s", step).withColumn("adjusted", F.max("_s").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def block_bootstrap(rows: DataFrame, groups: list[str], at: str, value: str, iterations: int = 10_000, confidence: float = 0.90, seed: int = 1) -> DataFrame:
    """(groups, n, weeks, lower, upper, p_value): ISO weeks resampled with replacement, means of pooled values.

    A draw is the leading 32 bits of an MD5 of seed, group, iteration and slot, modulo the weeks, so it does not depend on
    partitions and SQL can repeat it. Only weekly sums take part: a group's weeks, as many as the calendar has,
    are one array, and each iteration is a row that folds it.
    """
    week = F.concat_ws("-", F.expr(f"extract(yearofweek FROM {at})"), F.lpad(F.weekofyear(at).cast("string"), 2, "0"))
    weekly = rows.groupBy(*groups, week.alias("_week")).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    sizes = weekly.groupBy(*groups).agg(F.count("*").alias("weeks"), F.sum("_n").alias("n"), F.sort_array(F.collect_list(F.struct("_week", "_s", "_n"))).alias("_w"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = sizes.select(*groups, "weeks", "n", "_w", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("_b")).repartition(parts, *groups, "_b")
    label = F.concat_ws(":", F.lit(str(seed)), *(F.col(g).cast("string") for g in groups), F.col("_b").cast("string"))
    pick = lambda slot: F.get(F.col("_w"), (F.conv(F.substring(F.md5(F.concat_ws(":", label, slot.cast("string"))), 1, 8), 16, 10).cast("long") % F.col("weeks")).cast("int"))
    drawn = F.transform(F.sequence(F.lit(0), F.col("weeks").cast("int") - 1), pick)
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("n"))
    folded = F.aggregate(drawn, zero, lambda a, w: F.struct((a["s"] + w["_s"]).alias("s"), (a["n"] + w["_n"]).alias("n")), lambda a: a["s"] / a["n"])
    means = runs.select(*groups, "weeks", "n", "_b", folded.alias("_m"))
    alpha = (1 - confidence) / 2
    order = F.row_number().over(Window.partitionBy(*groups).orderBy("_m", "_b")) - 1  # `iterations` rows of two numbers
    lo, hi = max(0, int(alpha * iterations)), min(iterations - 1, int((1 - alpha) * iterations))
    return means.withColumn("_k", order).groupBy(*groups, "weeks", "n").agg(F.max(F.when(F.col("_k") == lo, F.col("_m"))).alias("lower"), F.max(F.when(F.col("_k") == hi, F.col("_m"))).alias("upper"), ((1 + F.count_if(F.col("_m") >= 0)) / (1 + iterations)).alias("p_value"))


def halves(rows: DataFrame, groups: list[str], order: list[str], value: str) -> DataFrame:
    """Means of the earlier n//2 rows and of the rest. order begins with a date or time."""
    marked = bucketed(rows, groups, day(order[0]), order, {"_rank": F.lit(1)}).withColumn("_first", F.col("_rank") <= F.floor(F.col("_rank_all") / 2))
    return marked.groupBy(*groups).agg(F.count("*").alias("n"), F.avg(F.when(F.col("_first"), F.col(value))).alias("first_half"), F.avg(F.when(~F.col("_first"), F.col(value))).alias("second_half"))


def review_gate(m: DataFrame, fixtures: int = 100, days: int = 90, hits: int = 50, batch_hits: int = 25, residual: float = -0.03, relative: float = -0.03, level: float = 0.10) -> DataFrame:
    """passed and failed conditions of a rule's review. m: fixtures, span_days, rule_hits, first_hits, second_hits, residual, relative_residual, first_residual, second_residual, upper, adjusted_p."""
    checks = {
        "fixtures": F.col("fixtures") >= fixtures, "span_days": F.col("span_days") >= days, "rule_hits": F.col("rule_hits") >= hits,
        "first_hits": F.col("first_hits") >= batch_hits, "second_hits": F.col("second_hits") >= batch_hits, "residual": F.col("residual") <= residual,
        "relative_residual": F.col("relative_residual") <= relative, "first_residual": F.col("first_residual") < 0, "second_residual": F.col("second_residual") < 0,
        "upper": F.col("upper") < 0, "adjusted_p": F.col("adjusted_p") <= level,
    }
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), k) for k, c in checks.items())))
    return m.select("*", failed.alias("failed"), (F.size(failed) == 0).alias("passed"))


LEVELS = {
    False: (("L1", ("top_outcome", "probability_bin", "gap_bin", "line_bucket", "total_bucket")), ("L2", ("probability_bin", "gap_bin", "line_bucket", "total_bucket")), ("L3", ("probability_bin", "gap_bin", "total_bucket")), ("L4", ("probability_bin", "total_bucket")), ("L5", ())),
    True: (("D1", ("top_outcome", "probability_bin", "gap_bin", "total_bucket")), ("D2", ("probability_bin", "gap_bin", "total_bucket")), ("D3", ("probability_bin", "total_bucket")), ("D4", ())),
}


def cohorts(queries: DataFrame, history: DataFrame, query_id: str, least: int = 30, draw: bool = False, cutoff: str | None = None, label_at: str | None = None) -> DataFrame:
    """(query_id, level, n, fallback): the first cohort level with at least `least` history rows, else the last.

    Each row falls into one cell of each level. History is counted by cell once for all levels, and queries
    look their cells up. With cutoff and label_at (as-of access) a query sees the history labelled by
    its cutoff: both run through the cells together in order of time.
    """
    levels = LEVELS[draw]
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("_i"), F.to_json(F.struct(*(F.coalesce(F.col(f).cast("string"), F.lit("-")).alias(f) for f in fields))).alias("_cell") if fields else F.lit("").alias("_cell")) for i, (_, fields) in enumerate(levels)))).alias("_c")
    asked = queries.select(query_id, *([cutoff] if cutoff else []), cells).select(query_id, *([F.col(cutoff).alias("_at")] if cutoff else []), "_c.*")
    past = history.select(*([F.col(label_at).alias("_at")] if cutoff else []), cells).select(*(["_at"] if cutoff else []), "_c.*")
    if cutoff:
        both = past.select("_i", "_cell", "_at", F.lit(0).alias("_asks"), F.lit(None).cast(queries.schema[query_id].dataType).alias(query_id)).unionByName(asked.select("_i", "_cell", "_at", F.lit(1).alias("_asks"), query_id))
        ran = bucketed(staged(both), ["_i", "_cell"], day("_at"), ["_at", "_asks"], {"n": 1 - F.col("_asks")})  # read twice
        found = ran.where("_asks = 1").select(query_id, "_i", "n")
    else:
        counts = past.groupBy("_i", "_cell").agg(F.count("*").alias("n"))
        found = asked.join(counts, ["_i", "_cell"], "left").select(query_id, "_i", F.coalesce("n", F.lit(0)).alias("n"))
    ok = found.where((F.col("n") >= least) | (F.col("_i") == len(levels) - 1))
    best = ok.groupBy(query_id).agg(F.min(F.struct("_i", "n")).alias("_b"))
    return best.select(query_id, F.get(F.array(*(F.lit(name) for name, _ in levels)), F.col("_b._i")).alias("level"), F.col("_b.n").alias("n"), (F.col("_b._i") > 0).alias("fallback"))


#: Stand-ins of three rules on past fixtures (rows of odds.history_row with favourite_odds_delta and total_line).
PROXIES = {
    "r1_shallow_favorite_cooling": ("r1_aggregate_odds_partial_proxy", "NOT draw_is_top AND abs(favourite_line) IN (0.25, 0.5) AND round(favourite_odds_delta, 9) >= 0.03"),
    "r2_asian_retreat": ("r2_aggregate_retreat_proxy", "NOT draw_is_top AND round(top_probability, 9) >= 0.45 AND round(top_gap, 9) >= 0.07 AND favourite_line_delta <= -0.25"),
    "r3_low_total_draw_tail": ("r3_final_closing_proxy", "NOT draw_is_top AND total_line <= 2.25 AND round(p[1], 9) >= 0.28 AND abs(favourite_line) <= 0.5"),
}


#: Rules that past fixtures can't stand in for, and why.
NO_PROXY = {"r0_data_integrity": "not_applicable", "r2_euro_strong_asian_flat": "not_available_in_dataset", "r4_handicap_cover_conflict": "not_available_in_dataset", "r5_live_market_stability": "not_available_in_dataset"}


def history_proxies(shapes: DataFrame, least: int = 30, spread: str | None = None) -> DataFrame:
    """(rule, proxy_id, evaluability, fixtures, status, log_loss, brier, rps, accuracy, median, p75, p90) of each rule's stand-in over scored shapes.

    No metrics below `least` fixtures. One pass for all rules. spread: a column of how far bookmakers are apart, of which the rule on dispersion has a distribution only.
    """
    hits = F.array_compact(F.array(*(F.when(F.expr(cond), F.struct(F.lit(rule).alias("rule"), F.lit(proxy).alias("proxy_id"))) for rule, (proxy, cond) in PROXIES.items())))
    found = shapes.select("*", F.explode(hits).alias("_h")).groupBy("_h.rule", "_h.proxy_id").agg(F.count("*").alias("fixtures"), *(F.avg(m).alias(m) for m in ("log_loss", "brier", "rps")), F.avg("hit").alias("accuracy"))
    kinds = [(rule, proxy, "retrospective_final_closing_proxy") for rule, (proxy, _) in PROXIES.items()] + [(rule, None, why) for rule, why in NO_PROXY.items()]
    names = shapes.sparkSession.createDataFrame(kinds, "rule string, proxy_id string, evaluability string")
    all_rules = names.join(found, ["rule", "proxy_id"], "left").withColumn("fixtures", F.when(F.col("proxy_id").isNotNull(), F.coalesce("fixtures", F.lit(0))))
    enough = F.col("fixtures") >= least
    status = F.when(enough, "available").when(F.col("proxy_id").isNotNull(), "insufficient_sample")
    out = all_rules.select("rule", "proxy_id", "evaluability", "fixtures", status.alias("status"), *(F.when(enough, F.col(m)).alias(m) for m in ("log_loss", "brier", "rps", "accuracy")), *(F.lit(None).cast("double").alias(c) for c in ("median", "p75", "p90")))
    if spread is None:
        return out
    wide = order_statistics(shapes, [], spread, MIDDLE | {"p75": fraction_rank(0.75), "p90": fraction_rank(0.90)})
    kind = [F.lit("r6_bookmaker_dispersion").alias("rule"), F.lit("different_metric_distribution_only").alias("evaluability")]
    return out.unionByName(wide.select(*kind, ((F.col("_below") + F.col("_above")) / 2).cast("double").alias("median"), F.col("p75").cast("double"), F.col("p90").cast("double")), allowMissingColumns=True)


def stability(rows: DataFrame, groups: list[str], season: str, residual: str, seasons: tuple[str, str], least: int) -> DataFrame:
    """(groups, n and residual by season, status): same_sign, opposite_sign, or insufficient_sample."""
    a, b = seasons
    agg = [x for i, s in enumerate((a, b)) for x in (F.count_if(F.col(season) == s).alias(f"n{i}"), F.avg(F.when(F.col(season) == s, F.col(residual))).alias(f"r{i}"))]
    got = rows.groupBy(*groups).agg(*agg)
    status = F.when((F.col("n0") < least) | (F.col("n1") < least), "insufficient_sample").when(F.signum("r0") == F.signum("r1"), "same_sign").otherwise("opposite_sign")
    return got.withColumn("status", status)


def split_by_date(df: DataFrame, at: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """(train, evaluation): before the cut, and from it on."""
    return df.where(F.col(at) < F.lit(cut)), df.where(F.col(at) >= F.lit(cut))


LOG_3 = math.log(3)


def delta_vs_uniform() -> list[Column]:
    """Aggregates over scored rows: how much better or worse than one third each."""
    uniform_rps = F.avg(F.when(F.col("actual") == 1, 1 / 9).otherwise(5 / 18))
    return [(F.avg("log_loss") - LOG_3).alias("delta_log_loss"), (F.avg("brier") - 2 / 3).alias("delta_brier"), (F.avg("rps") - uniform_rps).alias("delta_rps")]
