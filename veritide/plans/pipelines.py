"""Compositions of operators that users run as one job. Frames in, frames out; `now` is always a parameter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.functions import ids, odds
from veritide.functions.parse import source_role
from veritide.operators import asof, contracts, evidence, market, models, reports, rules, score, versions
from veritide.operators.staged import staged
from veritide.sources import facts
from veritide.sources import odds as odds_files
from veritide.streaming import states


def import_facts(spark: SparkSession, path: str, stored: DataFrame | None = None, checkpoints: DataFrame | None = None) -> dict[str, DataFrame]:
    """new records with event time and sha256, rejected lines, conflicting ids, records of unknown type, checkpoints, and files that broke the append-only rule since the checkpoints given.

    stored: record_id of what was imported before, and with sha256 its contents, so that a stored id with other content is a conflict. Files that broke the rule give no lines.
    """
    broken = None
    if checkpoints is not None:
        broken = facts.append_violations(spark, path, checkpoints)
    lines = facts.scan(spark, path, checkpoints)
    if broken is not None:
        lines = lines.join(broken.select("file"), "file", "left_anti")
    records, rejected = facts.validated(lines)
    new = facts.with_event_time(facts.new_records(records, stored)).withColumn("sha256", F.sha2("raw", 256))
    known = stored if stored is not None and "sha256" in stored.columns else None
    out = {"new": new, "rejected": rejected, "conflicts": facts.conflicts(records, known), "unsupported": contracts.unsupported(new, "record_type", (*facts.TYPES, *facts.RESEARCH_TYPES)), "checkpoints": facts.checkpoint(records)}
    return out if broken is None else out | {"violations": broken}


def import_research(spark: SparkSession, path: str, stored: DataFrame) -> dict[str, DataFrame]:
    """files (file, sha256, status: new, existing or changed), new records, and rejected lines of research logs. stored: file, sha256.

    A file is taken whole or not at all: one that is stored is not read again beyond its hash, one whose hash changed is a violation and gives nothing, and of a
    new one with a line that breaks the contract or whose flags don't fit its kind every line is rejected.
    """
    name = F.regexp_replace("path", "^file:/+", "file:///")
    found = facts.blobs(spark, path).select(name.alias("path"), "size", "sha256")
    files = facts.manifest_changes(found, stored.withColumnRenamed("file", "path")).withColumnRenamed("path", "file")
    known = files.where("status != 'new'").join(found.select(F.col("path").alias("file"), F.col("size").alias("offset")), "file")
    lines = facts.scan(spark, path, known.select("file", "offset", F.lit(0).cast("long").alias("line"), F.col("offset").alias("last_start")))
    flags = F.from_json("raw", "research_kind string, research_only boolean, backfill boolean, strict_backtest_eligible boolean, cutoff_eligible boolean").alias("_f")
    records, rejected = facts.validated(lines)
    broken = records.select("file", flags).select("file", "_f.*").where(~F.coalesce(contracts.flag_contract(), F.lit(False))).select("file").distinct()
    return {"files": files, "new": records.join(broken, "file", "left_anti"), "rejected": rejected.unionByName(records.join(broken, "file", "left_semi"))}


def current_views(records: DataFrame) -> dict[str, DataFrame]:
    """Typed tables with derived views: current normalizations and rows, current verified results, invalidated fixtures."""
    of = lambda k: facts.typed(records, k)
    gone = states.invalidated(of("QualityEvent"), "fixture_id")
    norms = versions.current_derivation(of("MarketNormalization"), ["snapshot_record_id"], "normalization_version", "normalized_at", "record_id", F.col("status") == "accepted")
    rows = of("BookmakerMarketRow").join(norms.select(F.col("record_id").alias("normalization_record_id")), "normalization_record_id", "left_semi")
    verified = versions.not_superseded(of("VerifiedResult"), "record_id", "supersedes_record_id", F.col("verification_status") == "accepted")
    latest = versions.latest(verified.where("verification_status = 'accepted'"), ["fixture_id"], ["confirmed_at", "record_id"])
    return {"normalizations": norms, "rows": versions.without(rows, gone, ["fixture_id"]), "verified": versions.without(latest, gone, ["fixture_id"]), "invalidated": gone}


def strict_results(batches: DataFrame, verified: DataFrame) -> DataFrame:
    """Fixtures with an eligible batch at a target and a current verified result."""
    return batches.where("model_strict_eligible").join(verified, "fixture_id").select("fixture_id", "target", "home_goals", "away_goals").distinct()


def market_rows_as_of(rows: DataFrame, fixture: str, cutoff: Column, limit: int = 1000) -> DataFrame:
    """Rows of a fixture known by a cutoff, in order; limit from 1 to 10000."""
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must be from 1 to 10000")
    return asof.rows_as_of(rows.where(F.col("fixture_id") == fixture), cutoff).orderBy("observed_at", "market", "record_id").limit(limit)


#: The same as a parameterised statement over a view market_rows.
AS_OF_SQL = "SELECT * FROM market_rows WHERE fixture_id = :fixture AND observed_at <= :cutoff AND (corrected_at IS NULL OR corrected_at <= :cutoff) ORDER BY observed_at, market, record_id"


def normalise_odds(files: DataFrame, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fixtures, market observations, skip counts) of wide odds rows."""
    named = odds_files.with_identity(files) if "skip_reason" not in files.columns else files
    keyed = named.withColumn("fixture_record_id", ids.stable_id(source, "competition", "match_date", "home_team", "away_team"))
    good = keyed.where("skip_reason is null")
    fixtures = good.select("fixture_record_id", "competition", "match_date", "home_team", "away_team", "home_goals", "away_goals").dropDuplicates(["fixture_record_id"])
    return fixtures, market.wide_to_long(good, ["fixture_record_id"]), keyed.groupBy("skip_reason").agg(F.count("*").alias("n"))


def baseline_points(fixtures: DataFrame, observations: DataFrame, cohort: str = "closing") -> DataFrame:
    """Fixtures with a result, their average consensus p and a running prior."""
    prices = observations.where((F.col("market") == "1x2") & (F.col("cohort") == cohort))
    d = odds.devig(F.col("prices")[0], F.col("prices")[1], F.col("prices")[2], rule="finite")
    agreed = market.average_consensus(prices.withColumn("p", d["p"]).where("p is not null"), ["fixture_record_id"], "bookmaker")
    rows = fixtures.where("home_goals is not null and away_goals is not null").join(agreed, "fixture_record_id").withColumn("actual", odds.outcome("home_goals", "away_goals")).withColumn("year", F.year("match_date").cast("string"))
    first = F.year("match_date") == 2025
    return score.running_prior(rows, ["competition"], ["match_date", "fixture_record_id"], "actual", first)


BASELINES = ("uniform", "prior", "market")


def evaluate_baseline(points: DataFrame, years: tuple[str, ...] = ()) -> DataFrame:
    """Metrics of uniform, prior and market forecasts by year and competition, with the calibration error of each cell.

    years: the cells are these years and all, for each competition and all, also those without points (sample_size 0, no metrics).
    """
    rows = score.scored(score.with_baselines(points, "p", "prior"))
    cube = score.grouped_metrics(rows, [("baseline",), ("baseline", "year"), ("baseline", "competition"), ("baseline", "year", "competition")])
    cells = [F.struct(F.lit("all").alias("year"), F.lit("all").alias("competition")), F.struct(F.col("year"), F.lit("all").alias("competition")), F.struct(F.lit("all").alias("year"), F.col("competition")), F.struct(F.col("year"), F.col("competition"))]
    spread = rows.select("baseline", "top", "hit", F.explode(F.array(*cells)).alias("c")).select("baseline", "c.*", "top", "hit")
    keys = ["baseline", "year", "competition"]
    found = cube.join(score.calibration_error(spread, keys).drop("n"), keys, "left")
    if not years:
        return found
    names = points.select("competition").distinct().unionByName(points.sparkSession.createDataFrame([("all",)], "competition string"))
    grid = names.withColumn("year", F.explode(F.array(*map(F.lit, (*years, "all"))))).withColumn("baseline", F.explode(F.array(*map(F.lit, BASELINES))))
    return score.full_grid(found, grid.select(*keys), keys)


def model_dataset(points: DataFrame, cut: str) -> dict[str, DataFrame]:
    """train and evaluation by date, and the hash of the whole; an empty train part is an error."""
    train, later = score.split_by_date(points, "match_date", cut)
    if train.isEmpty():
        raise ValueError("no rows before the cut")
    member = F.concat_ws("|", "fixture_record_id", "match_date", "actual", F.array_join(F.transform("p", lambda x: F.round(x, 12).cast("string")), ","))
    return {"train": train, "evaluation": later, "hash": ids.dataset_hash(points.select(member.alias("m")), "m")}


def identity_targets(identities: DataFrame, named: DataFrame, now: Column, lookback_hours: int = 2, lookahead_hours: int = 48) -> DataFrame:
    """Each fixture's open targets with the identity that was known at the target's own cutoff.

    A version counts for a target only if it was observed by the cutoff that its own kickoff gives; the latest such one
    stands, so a kickoff that moved later does not publish for an old cutoff. Fixtures far from now are left out first.
    """
    near = asof.due(identities, now, "kickoff_at", lookback_hours, lookahead_hours)
    known = asof.cutoffs(near, named).where(F.col("observed_at") <= F.col("cutoff"))
    return asof.publishable(versions.latest(known, ["fixture_id", "target"], ["observed_at", "record_id"]), now)


def shadow_predictions(identities: DataFrame, batches: DataFrame, quotes: DataFrame, registry: DataFrame, aliases: DataFrame, stats: DataFrame, published: DataFrame, named: DataFrame, now: Column, activations: DataFrame, channel: str = "shadow") -> DataFrame:
    """Predictions that may be published at `now` under the channel's active model, with confidence or the reason to abstain; each (fixture, target, cutoff) once.

    identities: versions (fixture_id, record_id, observed_at, kickoff_at, competition_id, competition_name, competition_format);
    batches: fixture_id, target, record_id, core_observed_at, completed_at; quotes: record_id of the batch, book, p;
    registry: profile_id, confidence_cap, classification_status, market_evidence_tier; stats: profile_id, fixtures, span_days;
    activations: see models.activation(); a channel without an active model is an error.
    """
    model = models.required_model(activations, channel, now)
    planned = identity_targets(identities, named, now).withColumn("available_at", now).withColumnRenamed("record_id", "identity_record_id")
    keyed = planned.withColumn("qid", ids.stable_id(channel, "fixture_id", "target", "cutoff"))
    b = batches.withColumnRenamed("record_id", "snapshot_record_id")
    found = asof.asof_join(keyed, b, ["fixture_id", "target"], "qid", "cutoff", "core_observed_at", "snapshot_record_id", ("available_at", "completed_at"), ["snapshot_record_id"])
    resolved = evidence.resolve(found, registry, aliases, "competition_id", "competition_name")
    flags = resolved.withColumns({"conflict": F.col("resolution") == "conflict", "unregistered": F.col("resolution") == "unregistered"}).join(registry, "profile_id", "left")
    agreed = market.consensus(quotes.withColumnRenamed("record_id", "snapshot_record_id"), ["snapshot_record_id"], "book", 1)
    rows = flags.join(agreed, "snapshot_record_id", "left").join(stats.select("profile_id", F.col("fixtures").alias("verified_fixtures"), "span_days"), "profile_id", "left")
    rows = rows.na.fill({"verified_fixtures": 0, "span_days": 0, "confidence_cap": "low", "classification_status": "provisional", "market_evidence_tier": "D"})
    rated = rules.confidence(rows).withColumn("abstention_reason", rules.abstention(rows))
    out = rated.withColumn("status", F.when(F.col("abstention_reason").isNull(), "published").otherwise("abstained"))
    return states.publish_once(out.crossJoin(model), published, ["fixture_id", "target", "cutoff"])  # one row


def evaluate_shadow(predictions: DataFrame, results: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """By each dimension and overall: all predictions, those published, and scores of the published ones that have a result; nulls read legacy_unclassified.

    Predictions without a result, and abstentions, stay in the counts.
    """
    rows = predictions.join(results, "fixture_id", "left").withColumn("actual", F.when(F.col("status") == "published", odds.outcome("home_goals", "away_goals")))
    own = F.col("actual").isNotNull()
    counts = [F.count("*").alias("predictions"), F.count_if(F.col("status") == "published").alias("published"), F.count_if((F.col("status") == "published") & ~own).alias("awaiting_result"), F.count_if(own).alias("sample_size")]
    means = [F.avg(F.when(own, F.col(m))).alias(name) for m, name in (("log_loss", "log_loss"), ("brier", "brier"), ("rps", "rps"), ("hit", "accuracy"))]
    return reports.by_dimensions(score.scored(rows), dimensions, [*counts, *means], "legacy_unclassified")


def train_model(points: DataFrame, cut: str, model_key: str, trained_at: Column, channel: str | None = None) -> dict[str, DataFrame]:
    """The dataset of model_dataset(), its model version, and with a channel the activation from then on."""
    data = model_dataset(points, cut)
    version = models.model_version(data["hash"], model_key, trained_at)
    return data | {"version": version} | ({"activation": models.activation(version, channel, trained_at)} if channel else {})


PRICED = {"ouzhi": ("home", "draw", "away"), "yazhi": ("home", "line", "away"), "daxiao": ("over", "line", "under")}


def _selected(rows: DataFrame, market_name: str, keys: list[str], bookmaker: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(complete rows of a market, one for each real bookmaker, bookmakers that contradict themselves)."""
    fields = [f"{side}_{f}" for side in ("opening", "current") for f in PRICED[market_name]]
    complete = rows.where((F.col("market") == market_name) & reduce(lambda a, b: a & b, (F.col(f).isNotNull() for f in fields)) & (source_role(bookmaker) == "bookmaker"))
    return market.one_row(complete.select(*keys, F.trim(bookmaker).alias("book"), *fields, *order), keys, "book", fields, order)


def _priced(keyed: DataFrame, market_name: str, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """_selected() for rows with a bookmaker_key."""
    fields = [f"{side}_{f}" for side in ("opening", "current") for f in PRICED[market_name]]
    complete = keyed.where((F.col("market") == market_name) & reduce(lambda a, b: a & b, (F.col(f).isNotNull() for f in fields)))
    return market.one_row(complete.select(*keys, F.col("bookmaker_key").alias("book"), *fields, *order), keys, "book", fields, order)


def first_guardrail_features(rows: DataFrame, index: DataFrame, series: DataFrame, keys: list[str], order: list[str], least: int = 3, bookmaker: str = "source_bookmaker_name") -> DataFrame:
    """Features of the first guardrail for every key (such as fixture and target) at once, from market rows.

    rows: keys, market, bookmaker, opening_ and current_ prices, order; index: keys, book, line, home, draw, away probabilities, order;
    series: keys, observed_at, line, probability: the live observations of a key. Tables that staged.dealt() has dealt by the keys are not shuffled again. Hard reasons say which market has too few bookmakers,
    too few pairs, or a bookmaker that contradicts itself.
    """
    picked = {m: _selected(rows, m, keys, bookmaker, order) for m in PRICED}
    euro = picked["ouzhi"][0]
    current = market.quotes(euro.select(*keys, "book", *(F.col(f"current_{s}").alias(s) for s in odds.SIDES)), keys, "book", odds.SIDES, "finite")
    agreed = staged(market.consensus(current, keys, "book", 1))  # used four times
    pairs = euro.select(*keys, *(F.struct(*(F.col(f"{side}_{s}").cast("double").alias(s) for s in odds.SIDES)).alias(side) for side in ("opening", "current")))
    lines = picked["yazhi"][0].select(*keys, F.col("opening_line").cast("double"), F.col("current_line").cast("double"))
    total = {"daxiao": [F.median(F.col("current_line").cast("double")).alias("total_line")]}
    counts = reduce(lambda a, b: a.join(b, keys, "full"), (picked[m][0].groupBy(*keys).agg(F.count("*").alias(f"n_{m}"), *total.get(m, [])) for m in PRICED))
    bad = reduce(DataFrame.unionByName, (picked[m][1].select(*keys, F.concat_ws(":", F.lit("duplicate_company_conflict"), F.lit(m), "book").alias("code")) for m in PRICED)).groupBy(*keys).agg(F.collect_set("code").alias("conflicts"))
    seen = versions.trajectory(series, keys, "observed_at", ["line", "probability"])
    out = rows.select(*keys).distinct().join(counts, keys, "left").join(bad, keys, "left").join(agreed, keys, "left").join(market.movement(pairs, keys, agreed), keys, "left").join(market.line_movement(lines, keys, agreed), keys, "left")
    out = out.join(market.cover_conflict(index, keys, agreed, bookmaker="book", order=order), keys, "left").join(seen, keys, "left")
    few = [F.when(F.coalesce(f"n_{m}", F.lit(0)) < least, f"insufficient_bookmakers:{m}") for m in PRICED]
    few += [F.when(F.coalesce("bookmakers", F.lit(0)) < least, "insufficient_paired_bookmakers:ouzhi"), F.when(odds.favourite("p").isin(0, 2) & (F.coalesce("paired_lines", F.lit(0)) < least), "insufficient_paired_bookmakers:yazhi")]
    reasons = F.array_sort(F.array_union(F.coalesce("conflicts", F.array().cast("array<string>")), F.array_compact(F.array(*few))))
    side = odds.favourite_side("p")
    return out.withColumns({"favourite_side": side, "hard_reasons": reasons}).drop("conflicts")


def second_guardrail_features(rows: DataFrame, series: DataFrame, keys: list[str], order: list[str], least: int = 3, bookmaker: str = "source_bookmaker_name", ident: str = "source_bookmaker_id") -> DataFrame:
    """Features of the second guardrail for every key at once: institutions across three markets, their signals, anomalies and series.

    rows as for the first guardrail, with the bookmaker's id; series: keys, book (as market.bookmaker_keys gives it), observed_at, record_id, probability, deviation of each institution's live observations.
    Institutions are paired by their key over all markets. What contradicts itself, in names, ids or prices, is left out, and pairing_warnings says so.
    """
    keyed, warned = market.bookmaker_keys(rows.where(source_role(bookmaker) == "bookmaker"), keys, bookmaker, ident)
    both = {m: _priced(keyed, m, keys, order) for m in PRICED}
    picked = {m: staged(kept) for m, (kept, _) in both.items()}  # each is used several times, and its rows come through windows and sorts
    clashes = reduce(DataFrame.unionByName, (bad.select(*keys, F.concat_ws(":", F.lit("duplicate_company_conflict"), "book", F.lit(m)).alias("warning")) for m, (_, bad) in both.items()))
    warnings = warned.unionByName(clashes).groupBy(*keys).agg(F.array_sort(F.collect_set("warning")).alias("pairing_warnings"))
    euro = picked["ouzhi"]
    price = lambda side: odds.devig(*(F.col(f"{side}_{s}") for s in odds.SIDES), rule="above_one")
    valid = euro.withColumns({"_o": price("opening"), "_c": price("current")}).where("_o is not null and _c is not null").select(*keys, "book", F.col("_c.p").alias("p"), F.zip_with("_c.p", "_o.p", lambda a, b: a - b).alias("delta"))
    quoted = valid.select(*keys, "book", "p")
    agreed = staged(market.consensus(quoted, keys, "book", 1).withColumn("base_direction", odds.favourite_side("p")))
    odd = market.anomalies(quoted, agreed, keys, "book").select(*keys, "book", "anomaly", "max_deviation")
    named = lambda m, cols: picked[m].select(*keys, "book", *(F.col(c).cast("double").alias(n) for c, n in cols.items()))
    asian = named("yazhi", {f"{s}_{f}": f"{s}_asian_{f}" for s in ("opening", "current") for f in ("line", "home", "away")})
    total = named("daxiao", {f"{s}_line": f"{s}_total_line" for s in ("opening", "current")})
    live = versions.series_states(series, [*keys, "book"], "observed_at", "record_id", "probability", "deviation").select(*keys, "book", F.col("states").alias("_live"), F.col("n").alias("_seen"), F.col("span").alias("_span"))
    each = market.signals(market.pair_markets(valid.join(agreed.select(*keys, "base_direction"), keys), asian, total, [*keys, "book"]), "base_direction").join(odd, [*keys, "book"], "left").join(live, [*keys, "book"], "left")
    own = F.array_compact(F.array(
        F.when(F.col("anomaly"), F.when(F.col("euro_signal") != "unchanged", "isolated_move").otherwise("cross_sectional_dissent")), F.when(F.col("internal_conflict"), "internal_cross_market_conflict"),
    ))
    each = each.withColumn("states", F.array_distinct(F.concat(F.coalesce("_live", F.array().cast("array<string>")), own)))
    share = lambda c: F.avg(c.cast("int"))
    judged = F.col("asian_signal").isin("confirm", "conflict", "flat")
    sums = each.groupBy(*keys).agg(
        F.count("*").alias("paired"), share(F.col("euro_signal") == "support").alias("support_ratio"), F.avg(F.when(judged, (F.col("asian_signal") == "confirm").cast("int"))).alias("confirm_ratio"), F.avg(F.when(judged, (F.col("asian_signal") == "conflict").cast("int"))).alias("conflict_ratio"),
        F.median(F.col("current_total_line") - F.col("opening_total_line")).alias("total_delta"), F.max("_seen").alias("observation_count"), F.max("_span").alias("span_seconds"),
        F.create_map(*(x for s in ("isolated_move", "cross_sectional_dissent", "one_off_spike", "persistent_dissent", "internal_cross_market_conflict", "unchanged_confirmed") for x in (F.lit(s), F.count_if(F.array_contains("states", s))))).alias("state_counts"),
    )
    counts = reduce(lambda a, b: a.join(b, keys, "full"), (picked[m].groupBy(*keys).agg(F.count("*").alias(f"n_{m}")) for m in PRICED))
    out = rows.select(*keys).distinct().join(counts, keys, "left").join(agreed, keys, "left").join(sums, keys, "left").join(market.leave_one_out(quoted, agreed, keys, "book"), keys, "left")
    few = [F.when(F.coalesce(f"n_{m}", F.lit(0)) < least, f"insufficient_bookmakers:{m}") for m in PRICED] + [F.when(F.coalesce("paired", F.lit(0)) < least, "insufficient_valid_1x2_bookmakers")]
    out = out.join(warnings, keys, "left")
    none = F.array().cast("array<string>")
    return out.withColumns({"hard_reasons": F.array_sort(F.array_compact(F.array(*few))), "pairing_warnings": F.coalesce("pairing_warnings", none), "paired": F.coalesce("paired", F.lit(0))})


def forward_review(assessed: DataFrame, rule_map: str = "rule_evaluations", at: str = "kickoff_at", iterations: int = 10_000) -> DataFrame:
    """Review of every rule on scored forward rows: residuals of hits against the rest, halves, bootstrap, Holm, gate."""
    rows = assessed.select("fixture_id", at, (F.col("hit") - F.col("top")).alias("v"), F.explode(rule_map).alias("rule", "state"))
    hit = rows.where("state = 'matched'")
    base = rows.groupBy("rule").agg(F.count_distinct("fixture_id").alias("fixtures"), F.datediff(F.max(at), F.min(at)).alias("span_days"), F.count_if(F.col("state") == "matched").alias("rule_hits"), F.avg(F.when(F.col("state") == "matched", F.col("v"))).alias("residual"), F.avg(F.when(F.col("state") == "not_matched", F.col("v"))).alias("_rest"))
    h = score.halves(hit, ["rule"], [at, "fixture_id"], "v")
    b = score.block_bootstrap(hit, ["rule"], at, "v", iterations)
    adjusted = score.holm(b.select("rule", "p_value"), "p_value", "rule").select("rule", F.col("adjusted").alias("adjusted_p"))
    m = base.join(h.select("rule", F.floor(F.col("n") / 2).alias("first_hits"), F.ceil(F.col("n") / 2).alias("second_hits"), F.col("first_half").alias("first_residual"), F.col("second_half").alias("second_residual")), "rule", "left")
    m = m.join(b.select("rule", "lower", "upper"), "rule", "left").join(adjusted, "rule", "left").withColumn("relative_residual", F.col("residual") - F.col("_rest")).drop("_rest")
    return score.review_gate(m)


#: The prices by which a row is known again after another normalisation: its name may be spelt anew.
SIGNATURE = ("current_first", "current_second", "opening_first", "opening_second")


def renormalise(exports: DataFrame, old_rows: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected snapshots): stored captures cut into cells and typed again; a snapshot must keep every old row, as often as it stood, by its prices (SIGNATURE)."""
    from veritide.functions.parse import export_rows

    cells = exports.select("snapshot", "market", F.explode(export_rows(body)).alias("r")).select("snapshot", "market", "r.row_index", "r.cells")
    rows = market.cells_to_rows(cells)
    signed = rows.select("*", *(F.col(f"two_way.{c}").alias(c) for c in SIGNATURE))
    ok = market.parity(old_rows, signed, "snapshot", list(SIGNATURE))
    bad = ok.where("not ok").select("snapshot")
    return rows.join(bad, "snapshot", "left_anti"), bad


def renormalise_window(exports: DataFrame, versions_held: DataFrame, old_rows: DataFrame, batches: DataFrame, start: Column, end: Column, version: int, at: Column) -> dict[str, DataFrame]:
    """Another normalisation of the captures of a time window, beside those that stand.

    exports: snapshot, market, captured_at, body; versions_held: snapshot, version, normalized_at, record_id, status; old_rows: snapshot, version and the columns of SIGNATURE;
    batches: batch_id, completed_at, snapshots (array), strict_eligible; a batch that was retried has several rows.
    A snapshot whose rows of its current version are all among the new ones, as often, gets an accepted version `version`, others a rejected one. Nothing that stands is changed.

    versions: all versions, old and new; current: the accepted one of each snapshot that stands, with the rows' version; rows: the new rows of accepted ones;
    assessments: one for each batch of the window, by its last try: data_complete where each of its snapshots has an accepted current version.
    """
    inside = exports.where((F.col("captured_at") >= start) & (F.col("captured_at") < end))
    stands = versions.current_derivation(versions_held, ["snapshot"], "version", "normalized_at", "record_id", F.col("status") == "accepted")
    kept_rows = old_rows.join(stands.select("snapshot", "version"), ["snapshot", "version"], "left_semi").join(inside.select("snapshot").distinct(), "snapshot", "left_semi")
    rows, bad = renormalise(inside, kept_rows)
    made = inside.select("snapshot").distinct().join(bad.withColumn("_bad", F.lit(True)), "snapshot", "left")
    status = F.when(F.col("_bad"), "rejected").otherwise("accepted")
    new = made.select("snapshot", F.lit(version).alias("version"), at.alias("normalized_at"), ids.stable_id("market_normalization", "snapshot", F.lit(version)).alias("record_id"), status.alias("status"))
    every = versions_held.select(*new.columns).unionByName(new)
    current = versions.current_derivation(every, ["snapshot"], "version", "normalized_at", "record_id", F.col("status") == "accepted")
    last = versions.retry_merge(batches.where((F.col("completed_at") >= start) & (F.col("completed_at") < end)), "batch_id", "completed_at", "strict_eligible")
    each = last.select("batch_id", "strict_eligible", F.explode_outer("snapshots").alias("snapshot")).join(current.select("snapshot", F.lit(True).alias("_ok")), "snapshot", "left")
    complete = F.coalesce(F.bool_and(F.coalesce("_ok", F.lit(False))), F.lit(False))
    judged = each.groupBy("batch_id").agg(F.first("strict_eligible").alias("collection_eligible"), complete.alias("data_complete"))
    marked = judged.withColumns({"model_strict_eligible": F.col("collection_eligible") & F.col("data_complete"), "record_id": ids.stable_id("eligibility_assessment", "batch_id", F.lit(version))})
    return {"versions": every, "current": current, "rows": rows, "assessments": marked}
