"""Registered queries of records, parsing, contracts, reviews and jobs, and the SQL that gives the same rows.

Bindings are those of queries.py: an order is a fixture, a line item a quote, an event an observation of a user.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritide.functions import ids, odds, parse
from veritide.operators import asof, contracts, evidence, market, models, reports, rules, score, versions
from veritide.operators.staged import dealt, folder, staged
from veritide.plans import guardrails, pipelines
from veritide.queries import SQL, _D, _Q, _SCORED, _agreed, _fixtures, _query, _quoted, _quotes, _r, _read, _scored
from veritide.sources import facts
from veritide.sources import lines as lines_source
from veritide.sources import odds as odds_files
from veritide.streaming import states


# --- records -------------------------------------------------------------------------------------------------------


#: Events of a file: so many ids go to a folder of each part, so the number of files grows with the events.
_FILE = 2000

_LOG = f"""l AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN event_id - 1 ELSE event_id END AS rid, user_id % 13 AS f, event_id // {_FILE} AS c, ts, event_type, CASE WHEN user_id % 13 = 5 AND event_id % 100 = 50 THEN 2 ELSE 1 END AS v FROM events
), bad AS (SELECT DISTINCT f, c FROM l WHERE v <> 1), ok AS (SELECT * FROM l WHERE (f, c) NOT IN (SELECT (f, c) FROM bad)), ko AS (SELECT * FROM l WHERE (f, c) IN (SELECT (f, c) FROM bad))"""


def _log_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events as lines of a log of 13 parts; repeated ids, and records of another schema version in part 5."""
    e = _read(spark, d, "events")
    rid = F.when(F.col("event_id") % 97 == 0, F.col("event_id") - 1).otherwise(F.col("event_id"))
    version = F.when((F.col("user_id") % 13 == 5) & (F.col("event_id") % 100 == 50), 2).otherwise(1)
    body = F.to_json(F.struct(F.concat(F.lit("r"), rid).alias("record_id"), F.initcap("event_type").alias("record_type"), version.alias("schema_version"), F.col("user_id").cast("string").alias("fixture_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at"), F.col("event_id").alias("n")))
    return e.select("event_id", body.alias("value"), (F.col("user_id") % 13).alias("part"), F.floor(F.col("event_id") / _FILE).alias("chunk"))


def _written(rows: DataFrame, sealed: bool = False) -> str:
    """A tree of JSONL files, one for each part and chunk."""
    out = folder(rows.sparkSession)
    lines_source.write(rows, ["part", "chunk"], ["event_id"], out, sealed)
    return out


_PART = [f"CAST(regexp_extract(file, '{name}=([0-9]+)', 1) AS BIGINT) AS {name}" for name in ("part", "chunk")]


@_query(f"""WITH {_LOG}, k AS (SELECT rid, arg_min(event_id, (f::VARCHAR, c::VARCHAR, event_id)) AS n, count(*) AS lines FROM ok GROUP BY rid)
SELECT 'new' AS what, 'r' || rid AS record_id, event_type AS kind, date_trunc('second', ts) AS event_at FROM k JOIN l USING (rid) WHERE k.n = l.event_id
UNION ALL SELECT 'rejected', 'r' || rid, event_type, NULL FROM ko
UNION ALL SELECT 'conflict', 'r' || rid, NULL, NULL FROM k WHERE lines > 1""")
def imported_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record that an import adds, every line of the files that it rejects, and the ids that stand for several contents."""
    got = pipelines.import_facts(spark, _written(_log_rows(spark, d)))
    row = lambda part, kind, at: got[part].select(F.lit(part).alias("what"), "record_id", kind.alias("kind"), at.cast("timestamp").alias("event_at"))
    kind, none = F.lower("record_type"), F.lit(None)
    every = row("new", kind, F.col("event_at")).unionByName(row("rejected", kind, none)).unionByName(row("conflicts", none.cast("string"), none))
    return every.withColumn("what", F.when(F.col("what") == "conflicts", "conflict").otherwise(F.col("what")))


@_query(f"""WITH {_LOG}, n AS (SELECT *, row_number() OVER (PARTITION BY f, c ORDER BY event_id) AS line, count(*) OVER (PARTITION BY f, c) AS lines FROM l
), s AS (SELECT f, c, any_value(lines) AS lines, CASE WHEN f = 3 AND any_value(lines) > 20 THEN 'shrunk' WHEN f = 7 AND any_value(lines) > 20 THEN 'tail_changed' WHEN f = 11 THEN 'missing' END AS violation FROM n GROUP BY f, c)
SELECT f AS part, c AS chunk, violation, CASE WHEN violation IS NULL THEN greatest(lines - 50, 0) END AS added, CASE WHEN violation IS NULL AND lines > 50 THEN 51 END AS first_line, CASE WHEN violation IS NULL AND lines > 50 THEN lines END AS last_line,
  CASE WHEN violation IS NULL AND lines > 50 THEN 'r' || (SELECT arg_max(rid, line) FROM n WHERE n.f = s.f AND n.c = s.c) END AS last_record_id FROM s""")
def incremental_scan(spark: SparkSession, d: str) -> DataFrame:
    """A log is scanned when its files have up to 50 lines, and again when most have grown: of part 3 files were cut to 20 lines, in part 7 the last known line is another, part 11 is gone."""
    rows = _log_rows(spark, d).withColumn("line", F.row_number().over(Window.partitionBy("part", "chunk").orderBy("event_id")))
    lines = F.count("*").over(Window.partitionBy("part", "chunk"))
    old = _written(rows.where("line <= 50"))
    changed = rows.withColumn("value", F.when((F.col("part") == 7) & (F.col("line") == F.least(F.lit(50), lines)) & (lines > 20), F.regexp_replace("value", '"record_id":"r', '"record_id":"q')).otherwise(F.col("value")))
    now = _written(changed.where("part != 11 AND (part != 3 OR line <= 20)"))
    seen = staged(facts.checkpoint(facts.scan(spark, old)).selectExpr("offset", "line", "last_start", "last_record_id", *_PART))
    # the files that stand now under the same part and chunk; of part 11 none does
    here = spark.createDataFrame([(f,) for f in lines_source.listed(now)], "file string").selectExpr("file", *_PART)
    before = seen.join(here, ["part", "chunk"], "left").withColumn("file", F.coalesce("file", F.concat(F.lit(f"{now}/part="), "part", F.lit("/chunk="), "chunk", F.lit("/gone"))))
    broken = facts.append_violations(spark, now, before).selectExpr(*_PART, "violation")
    added = facts.scan(spark, now, before).groupBy(*map(F.expr, _PART)).agg(F.count("*").alias("added"), F.min("line").alias("first_line"), F.max("line").alias("last_line"), F.max_by("record_id", "line").alias("last_record_id"))
    j = seen.select("part", "chunk").join(broken, ["part", "chunk"], "left").join(added, ["part", "chunk"], "left").withColumn("added", F.coalesce("added", F.lit(0)))
    fine = lambda c: F.when(F.col("violation").isNull(), F.col(c)).alias(c)
    return j.select("part", "chunk", "violation", fine("added"), fine("first_line"), fine("last_line"), fine("last_record_id"))


@_query("""SELECT o_orderstatus AS status, o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'historical' ELSE lower(o_orderpriority) END AS kind, 7 AS extra FROM orders""")
def patched_payloads(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders")
    payload = F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderstatus") != "F", F.lower("o_orderpriority")).alias("research_kind")))
    new = o.select("o_orderstatus", payload.alias("payload")).withColumn("payload", facts.patched("payload", {"research_kind": F.lit("historical")}, only_missing=True)).withColumn("payload", facts.patched("payload", {"extra": F.lit(7)}))
    field = lambda n: F.get_json_object("payload", f"$.{n}")
    return new.select(F.col("o_orderstatus").alias("status"), field("key").cast("long").alias("key"), field("research_kind").alias("kind"), field("extra").cast("int").alias("extra"))


_CSV = ("Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "B365H", "B365D", "B365A", "AvgCH", "AvgCD", "AvgCA")


@_query(f"""WITH {_Q}, w AS (SELECT fixture AS k, min(round(home, 2)) AS h, min(round(draw, 2)) AS dr, min(round(away, 2)) AS a FROM q GROUP BY fixture), m AS (SELECT w.*, sha256('s|E0|' || strftime(kickoff, '%Y-%m-%d') || '|H' || k || '|A' || k) AS id FROM w JOIN fx ON fixture = k)
SELECT 'price' AS what, id, 'opening' AS cohort, 'B365' AS bookmaker, h AS home, dr AS draw, a AS away, NULL::BIGINT AS n FROM m WHERE k % 50 <> 0 AND h > 1 AND dr > 1 AND a > 1
UNION ALL SELECT 'price', id, 'closing', 'Avg', round(h + 1, 2), round(dr + 1, 2), round(a + 1, 2), NULL FROM m WHERE k % 50 <> 0
UNION ALL SELECT 'skip', CASE WHEN k % 50 = 0 THEN 'missing_identity' END, NULL, NULL, NULL, NULL, NULL, count(*) FROM m GROUP BY 2""")
def normalised_odds(spark: SparkSession, d: str) -> DataFrame:
    """Quotes as a CSV file of wide odds rows, read again: long prices of each fixture, and how many rows were skipped for what."""
    q = _quotes(spark, d).groupBy("fixture").agg(*(F.min(F.round(s, 2)).alias(s) for s in odds.SIDES)).join(_fixtures(spark, d), "fixture")
    home = F.when(F.col("fixture") % 50 != 0, F.concat(F.lit("H"), "fixture"))
    cells = [F.lit("E0"), F.date_format("kickoff", "dd/MM/yyyy"), home, F.concat(F.lit("A"), "fixture"), F.col("actual"), F.lit(1), *(F.round(F.col(s), 2) for s in odds.SIDES), *(F.round(F.col(s) + 1, 2) for s in odds.SIDES)]
    out = folder(spark)
    q.select(*(c.cast("string").alias(n) for c, n in zip(cells, _CSV, strict=True))).write.option("header", True).csv(out)
    _, long, skips = pipelines.normalise_odds(odds_files.odds_csv(spark, [out]), "s")
    prices = long.select(F.lit("price").alias("what"), F.col("fixture_record_id").alias("id"), "cohort", "bookmaker", *(F.round(F.col("prices")[i], 2).alias(s) for i, s in enumerate(odds.SIDES)), F.lit(None).cast("long").alias("n"))
    return prices.unionByName(skips.select(F.lit("skip").alias("what"), F.col("skip_reason").alias("id"), "n"), allowMissingColumns=True)


@_query("""WITH c AS (SELECT user_id % 40 AS path, event_type, count(*) AS n FROM events GROUP BY 1, 2), g AS (SELECT path, sum(n) AS lines FROM c GROUP BY 1), m AS (SELECT DISTINCT user_id % 45 AS path FROM events)
SELECT m.path, array_to_string(list_filter([CASE WHEN m.path % 11 = 0 THEN 'status' END, CASE WHEN lines IS NULL THEN 'missing_file' END, CASE WHEN m.path % 5 <> 0 AND (lines IS NULL OR m.path % 7 = 0) THEN 'sha256' END, CASE WHEN m.path % 5 <> 0 AND (lines IS NULL OR m.path % 4 = 0) THEN 'lines' END, CASE WHEN m.path % 5 <> 0 AND (lines IS NULL OR m.path % 3 = 0) THEN 'types' END], lambda x: x IS NOT NULL), ',') AS failed FROM m LEFT JOIN g ON g.path = m.path""")
def published_batches(spark: SparkSession, d: str) -> DataFrame:
    """Manifests of batches against their content: some with a wrong status, hash, line count or type count, some of files that are gone; every fifth is of the old kind without a hash."""
    e = _read(spark, d, "events")
    content = e.select((F.col("user_id") % 40).alias("path"), F.concat(F.lit("h"), F.col("user_id") % 40).alias("sha256"), F.col("event_type").alias("record_type"))
    k = F.col("path")
    types = content.groupBy("path", "record_type").agg(F.count("*").alias("n")).groupBy("path").agg(F.sum("n").alias("lines"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("record_type", "n")))).alias("types"))
    m = e.select((F.col("user_id") % 45).alias("path")).distinct().join(types, "path", "left")
    off = F.transform_values("types", lambda _, n: n + F.when(k % 3 == 0, 1).otherwise(0))
    m = m.select("path", F.when(k % 11 == 0, "failed").otherwise("completed").alias("status"), F.when(k % 5 != 0, F.concat(F.when(k % 7 == 0, "x").otherwise("h"), k)).alias("sha256"), (F.coalesce("lines", F.lit(1)) + F.when(k % 4 == 0, 1).otherwise(0)).alias("lines"), F.coalesce(off, F.create_map(F.lit("z"), F.lit(1).cast("long"))).alias("types"))
    return facts.batch_gate(m, content).select("path", F.array_join("failed", ",").alias("failed"))


@_query("""SELECT sha256(text) AS sha256, count(*) AS observations, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def content_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Each text once by its hash, and who observed it."""
    cat, seen = facts.content_catalogue(_read(spark, d, "documents").where("text is not null"), "text")
    return cat.select("sha256", "observations").join(seen.groupBy("sha256").agg(F.min("doc_id").alias("first_doc")), "sha256")


@_query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum(event_id)::BIGINT AS keys FROM events GROUP BY 1""")
def days_written(spark: SparkSession, d: str) -> DataFrame:
    """Events published once as a run, appended by day, and read again by their folders."""
    out, runs = folder(spark), folder(spark)
    e = _read(spark, d, "events").select("event_id", "ts")
    said = [facts.write_once(e, runs, "r1", "event_id") for _ in range(2)]
    if said != ["written", "unchanged"]:
        raise ValueError(said)
    facts.append_by_day(facts.read_runs(spark, runs).drop("run_id"), out, "ts")
    got = spark.read.option("basePath", out).schema("event_id long, ts timestamp, yyyy string, mm string, dd string").parquet(out)
    return got.groupBy(F.concat_ws("-", "yyyy", "mm", "dd").alias("day")).agg(F.count("*").alias("n"), F.sum("event_id").alias("keys"))


@_query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 9 <> 0 AS id, o_custkey % 6 - 1 AS h, o_custkey % 4 AS a FROM orders), j AS (SELECT r.*, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN h ELSE h + 1 END END AS old FROM r)
SELECT k AS fixture_id, CASE WHEN NOT id OR h < 0 THEN 'rejected' WHEN old IS NULL THEN 'imported' WHEN old <> h THEN 'conflict' END AS part FROM j WHERE NOT (id AND h >= 0 AND old IS NOT NULL AND old = h) AND NOT (NOT id)
UNION ALL SELECT NULL, 'rejected' FROM r WHERE NOT id""")
def manual_results(spark: SparkSession, d: str) -> DataFrame:
    k, h = F.col("o_orderkey"), F.col("o_custkey") % 6 - 1
    o = _read(spark, d, "orders")
    rows = o.select(F.when(k % 9 == 0, F.concat(F.lit("x"), k)).otherwise(k.cast("string")).alias("fixture_id"), h.cast("string").alias("home_goals"), (F.col("o_custkey") % 4).cast("string").alias("away_goals"))
    old = o.where("o_orderkey % 3 = 0").select(k.alias("fixture_id"), F.when(k % 2 == 0, h).otherwise(h + 1).cast("int").alias("home_goals"), (F.col("o_custkey") % 4).cast("int").alias("away_goals"))
    parts = zip(("imported", "conflict", "rejected"), odds_files.manual_results(rows, old), strict=True)
    return reduce(DataFrame.unionByName, (df.select("fixture_id", F.lit(name).alias("part")) for name, df in parts))


@_query("""SELECT o_orderkey AS fixture_key, o_orderstatus = 'F' AS result_eligible, CASE WHEN o_orderstatus = 'F' THEN 'regular_time_90' ELSE 'ambiguous' END AS result_scope, o_orderstatus <> 'F' AS event FROM orders""")
def tournament_rows(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").select(F.col("o_orderkey").alias("fixture_key"), F.when(F.col("o_orderstatus") == "F", "90 minutes").when(F.col("o_orderstatus") == "O", "after extra time").alias("Finished"))
    rows, events = odds_files.tournament_rows(o)
    keys = events.select(F.get_json_object("details", "$.fixture_record_id").cast("long").alias("fixture_key"), F.lit(True).alias("event"))
    return rows.join(keys, "fixture_key", "left").select("fixture_key", "result_eligible", "result_scope", F.coalesce("event", F.lit(False)).alias("event"))


@_query("""WITH t AS (SELECT conv_id, count(*) AS n, max(turn) AS pages FROM conversations GROUP BY 1) SELECT c.conv_id, c.turn, c.role, greatest(CASE WHEN c.conv_id % 3 = 2 THEN 1 ELSE t.pages END, 1)::INT AS total_pages FROM conversations c JOIN t USING (conv_id)""")
def feed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Turns of a conversation as the rows of a feed body, under different keys."""
    c = _read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").cast("string").alias("turn"), "role")).alias("rows"), F.max("turn").alias("pages"))
    k = F.col("conv_id") % 3
    body = F.when(k == 0, F.to_json(F.struct(F.struct(F.col("rows").alias("matchResult"), F.col("pages").alias("totalPages")).alias("value")))).when(k == 1, F.to_json(F.struct("rows", "pages"))).otherwise(F.to_json(F.struct(F.col("rows").alias("list"))))
    f = odds_files.feed_rows(c.select("conv_id", body.alias("body")))
    return f.select("conv_id", F.col("row")["turn"].cast("long").alias("turn"), F.col("row")["role"].alias("role"), "total_pages")


def _dated(year: str, t: str) -> str:
    """A time of another year in SQL; null where that year lacks the day."""
    return f"CASE WHEN month({t}) = 2 AND day({t}) = 29 AND NOT (({year}) % 4 = 0 AND (({year}) % 100 <> 0 OR ({year}) % 400 = 0)) THEN NULL ELSE make_timestamp({year}, month({t}), day({t}), hour({t}), minute({t}), 0) END"


@_query(f"""WITH h AS (SELECT event_id, date_trunc('minute', ts) AS kick, (event_id % 701 - 350)::INT AS o FROM events), p AS (SELECT *, kick - to_days((event_id % 40)::INT) + CASE WHEN event_id % 2 = 0 THEN INTERVAL 0 DAY ELSE INTERVAL 2 YEAR END AS given FROM h
), c AS (SELECT *, {_dated('year(kick)', 'given')} AS c0, {_dated('year(kick) - 1', 'given')} AS c1 FROM p
), g AS (SELECT *, CASE WHEN epoch(kick) - epoch(c0) BETWEEN 0 AND 2592000 THEN c0 WHEN epoch(kick) - epoch(c1) BETWEEN 0 AND 2592000 THEN c1 END AS seen FROM c)
SELECT event_id, seen AS seen_at, CASE WHEN seen IS NULL THEN 'quarantined' WHEN seen = given THEN 'validated' ELSE 'year_corrected' END AS time_status, CASE WHEN o > 0 THEN round(1 + o / 100, 6) WHEN o < 0 THEN round(1 + 100 / abs(o), 6) END AS odds, seen IS NULL OR o = 0 AS quarantined FROM g""")
def odds_points(spark: SparkSession, d: str) -> DataFrame:
    """Points of nested odds histories; every second has a year too late, some are older than a month."""
    k = F.col("event_id")
    e = _read(spark, d, "events").withColumn("kickoff", F.date_trunc("minute", "ts")).withColumn("own", F.col("kickoff") - F.make_dt_interval((k % 40).cast("int")))
    point = F.struct(F.when(k % 2 == 0, F.col("own")).otherwise(F.col("own") + F.expr("INTERVAL 2 YEAR")).alias("timestamp"), (k % 701 - 350).cast("int").alias("odds"))
    group = F.struct(F.array(point).alias("history"), F.lit(None).cast("struct<timestamp:timestamp,odds:int>").alias("opening"))
    nested = e.select(k.cast("string").alias("match_id"), "kickoff", F.array(F.struct(F.lit("1x2").alias("market"), F.array(F.struct(F.lit("b").alias("bookmaker"), F.lit("full").alias("period"), F.array(group).alias("groups"))).alias("rows"))).alias("markets"))
    good, bad = odds_files.odds_history(nested)
    shown = lambda df, flag: df.select(F.col("match_id").cast("long").alias("event_id"), F.col("at").alias("seen_at"), "time_status", "odds", F.lit(flag).alias("quarantined"))
    return shown(good, False).unionByName(shown(bad, True))


# --- parsing -------------------------------------------------------------------------------------------------------


@_query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts) - INTERVAL 8 HOUR END AS strict, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts) - INTERVAL 8 HOUR ELSE date_trunc('second', ts) + INTERVAL 1 DAY END AS event_at FROM events""")
def strict_times(spark: SparkSession, d: str) -> DataFrame:
    """Times with Z, without a zone, with an offset and unreadable; the second column always reads."""
    k, text = F.col("event_id") % 4, lambda c, zone: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))
    first = F.when(k == 0, text("ts", "Z")).when(k == 1, text("ts", "")).when(k == 2, text("ts", "+08:00")).otherwise("soon")
    e = _read(spark, d, "events").select("event_id", first.alias("a"), text(F.col("ts") + F.expr("INTERVAL 1 DAY"), "Z").alias("b"))
    return e.select("event_id", parse.strict_timestamp("a").alias("strict"), parse.event_time("a", "b").alias("event_at"))


@_query("""SELECT p_partkey, p_name || ' ' || p_brand AS name, lower(regexp_replace(p_name || p_brand, '\\s+', '', 'g')) AS matched, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS shown FROM part""")
def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    """Names with wide letters, inner and outer white space."""
    p = _read(spark, d, "part")
    messy = F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t "), F.when(F.col("p_partkey") % 2 == 0, F.translate("p_brand", "Brand", "Ｂｒａｎｄ")).otherwise(F.col("p_brand")), F.lit(" "))
    return p.select("p_partkey", parse.canonical_name(messy).alias("name"), parse.canonical_name(messy, True).alias("matched"), parse.first_present(F.when(F.col("p_partkey") % 3 != 0, F.lit("  ")).otherwise(F.col("p_brand")), "p_type").alias("shown"))


@_query(f"""WITH t AS (SELECT event_id, ts, date_trunc('minute', ts) + to_days((event_id % 300)::INT) AS kick, date_trunc('minute', ts) + INTERVAL 3 YEAR AS later FROM events
), y AS (SELECT *, {_dated('year(kick)', 'ts')} AS now0, {_dated('year(kick) - 1', 'ts')} AS old0, {_dated('year(kick)', 'later')} AS now3, {_dated('year(kick) - 1', 'later')} AS old3 FROM t
), z AS (SELECT *, CASE WHEN epoch(kick) - epoch(now3) BETWEEN 0 AND 2592000 THEN now3 WHEN epoch(kick) - epoch(old3) BETWEEN 0 AND 2592000 THEN old3 END AS corrected FROM y)
SELECT event_id, CASE WHEN now0 > kick + INTERVAL 1 DAY THEN old0 ELSE now0 END AS dated, corrected, CASE WHEN corrected IS NULL THEN 'quarantined' WHEN corrected = later THEN 'validated' ELSE 'year_corrected' END AS status FROM z""")
def dated_times(spark: SparkSession, d: str) -> DataFrame:
    """Times without a year, and times with a wrong one (three years on)."""
    t = _read(spark, d, "events").withColumn("kick", F.date_trunc("minute", "ts") + F.make_dt_interval((F.col("event_id") % 300).cast("int")))
    fixed = parse.year_corrected(F.date_trunc("minute", "ts") + F.expr("INTERVAL 3 YEAR"), "kick")
    return t.select("event_id", parse.month_day_time(F.date_format("ts", "MM-dd HH:mm"), "kick").alias("dated"), fixed["ts"].alias("corrected"), fixed["status"].alias("status"))


@_query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS played, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_custkey % 10 AS INTEGER) END AS home, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 7 AS INTEGER) END AS away,
  CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS cancelled, CASE o_orderkey % 3 WHEN 0 THEN '0' WHEN 1 THEN (o_orderkey % 1000)::VARCHAR ELSE (o_orderkey % 1000)::VARCHAR || '.25' END AS price, epoch(CAST(o_orderdate AS DATE)::TIMESTAMP)::BIGINT - 28800 AS day_start FROM orders""")
def feed_scalars(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.when(k % 5 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(k % 5 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 5 == 2, F.date_format("o_orderdate", "d/M/yyyy")).when(k % 5 == 3, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-M-d"))).otherwise("2020-13-45")
    home, away = (F.col("o_custkey") % 10).cast("string"), (k % 7).cast("string")
    text = F.when(k % 3 == 0, F.concat_ws(":", home, away)).when(k % 3 == 1, F.concat(home, F.lit(" - "), away, F.lit(",x"))).otherwise("VS")
    said = F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "0").when(k % 4 == 2, "maybe")
    price = F.when(k % 3 == 0, F.lit(0)).when(k % 3 == 1, k % 1000).otherwise((k % 1000) + F.lit(0.25)).cast("decimal(20,6)")
    s = parse.score_text(text)
    o = _read(spark, d, "orders")
    return o.select("o_orderkey", parse.match_date(date).alias("played"), s["home"].alias("home"), s["away"].alias("away"), parse.cancelled(said).alias("cancelled"), parse.canonical_decimal(price).alias("price"), F.unix_timestamp(parse.day_bounds(F.to_date("o_orderdate"))["start"]).alias("day_start"))


@_query("""WITH b AS (SELECT conv_id, turn, string_split(array_to_string(list_transform(string_split(text, ' '), lambda w: w || '|x'), '$'), '$') AS rows FROM conversations WHERE text IS NOT NULL), r AS (SELECT conv_id, turn, unnest(rows) AS r, unnest(range(len(rows))) AS i FROM b)
SELECT conv_id, turn, count(*) AS n, sum(i)::BIGINT AS places, sum(len(string_split(r, '|')))::BIGINT AS cells FROM r WHERE trim(r) <> '' GROUP BY conv_id, turn""")
def export_cells(spark: SparkSession, d: str) -> DataFrame:
    """Words of a turn as rows of '$'-separated text with two cells each, cut again."""
    c = _read(spark, d, "conversations").where("text IS NOT NULL")
    body = F.array_join(F.transform(F.split("text", " "), lambda w: F.concat(w, F.lit("|x"))), "$")
    rows = c.select("conv_id", "turn", F.explode(parse.export_rows(body)).alias("r"))
    return rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n"), F.sum("r.row_index").alias("places"), F.sum(F.size("r.cells")).cast("long").alias("cells"))


@_query("""WITH c AS (SELECT l_orderkey AS sheet, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i, l_returnflag AS flag, l_partkey AS part FROM lineitem
), o AS (SELECT *, lead(part) OVER (PARTITION BY sheet ORDER BY i) AS nxt, i - row_number() OVER (PARTITION BY sheet, flag <> 'N' ORDER BY i) AS run FROM c), s AS (SELECT *, row_number() OVER (PARTITION BY sheet, run ORDER BY i) AS place FROM o WHERE flag <> 'N')
SELECT sheet, i AS row_index, part, nxt AS opening FROM s WHERE place % 2 = 1""")
def stride_rows(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    c = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("sheet"), i.alias("i"), "l_returnflag", F.array(F.col("l_partkey").cast("string")).alias("cells"))
    return market.stride_rows(c, ["sheet"], "i", F.col("l_returnflag") != "N").select("sheet", F.col("i").alias("row_index"), F.col("cells")[0].cast("long").alias("part"), F.get("opening", F.lit(0)).cast("long").alias("opening"))


@_query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber % 3 > 0 THEN round(l_discount + 0.5, 2)::DOUBLE END AS first_price, CASE WHEN l_linenumber % 3 = 1 THEN 2.25 WHEN l_linenumber % 3 = 2 THEN -0.25 END::DOUBLE AS line, CASE WHEN l_linenumber % 3 = 0 THEN round(l_tax * 100, 2)::DOUBLE END AS home_probability FROM lineitem""")
def typed_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of totals, handicaps and index rows, typed by their market."""
    l = _read(spark, d, "lineitem")
    k = F.col("l_linenumber") % 3
    name, price, share = F.concat(F.lit(" b"), F.col("l_suppkey").cast("string"), F.lit(" ")), F.format_number(F.col("l_discount") + 0.5, 2), F.concat(F.round(F.col("l_tax") * 100, 2).cast("string"), F.lit("%"))
    two = lambda line: F.array(name, price, F.lit(line), price, F.lit(""), price, F.lit(line), price, F.lit(""))
    index = F.array(name, F.lit("-1"), *([F.lit("1")] * 3), *([share] * 3), F.lit("95%"), *([F.lit("1")] * 3))
    cells = l.select("l_orderkey", "l_linenumber", "l_suppkey", F.when(k == 0, "rangqiu").when(k == 1, "daxiao").otherwise("yazhi").alias("market"), F.when(k == 0, index).when(k == 1, two("2/2.5")).otherwise(two("平手/半球")).alias("cells"))
    t = market.cells_to_rows(cells)
    return t.select("l_orderkey", "l_linenumber", F.expr("cast(substr(bookmaker, 2) AS bigint)").alias("l_suppkey"), F.col("two_way.current_first").cast("double").alias("first_price"), F.col("two_way.current_line").alias("line"), F.col("handicap_index.home_probability").cast("double").alias("home_probability"))


# --- prices --------------------------------------------------------------------------------------------------------


@_query("""WITH x AS (SELECT l_orderkey, l_linenumber, 0.5 + l_discount * 5 AS a, 0.4 + l_tax * 5 AS b FROM lineitem) SELECT l_orderkey, l_linenumber, round((1 / (1 + a)) / (1 / (1 + a) + 1 / (1 + b)), 8) AS p FROM x""")
def pair_prices(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(odds.devig_pair(0.5 + F.col("l_discount") * 5, 0.4 + F.col("l_tax") * 5)[0], 8).alias("p"))


_SHAPE = _SCORED + """, hs AS (SELECT sc.*, -(fixture % 7 - 3) * 0.25 AS home_line, (fixture % 5 - 2) * 0.25 AS ld, (fixture % 4) * 0.02 AS hd, (fixture % 3) * 0.02 AS ad, 1.75 + (fixture % 5) * 0.25 AS tot FROM sc
), hr AS (SELECT *, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS side, list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2] AS gap FROM hs
), hw AS (SELECT *, CASE side WHEN 'home' THEN -home_line WHEN 'away' THEN home_line END AS fl, CASE side WHEN 'home' THEN -ld WHEN 'away' THEN ld END AS fd, CASE side WHEN 'home' THEN hd WHEN 'away' THEN ad END AS od FROM hr)"""


def _history(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("fixture"), _scored(spark, d)
    shape = odds.history_row(F.col("p"), -((k % 7 - 3) * 0.25), (k % 5 - 2) * 0.25, (k % 4) * 0.02, (k % 3) * 0.02, 1.75 + (k % 5) * 0.25)
    return s.select("fixture", "kickoff", "competition", "log_loss", "brier", "rps", "hit", (1.75 + (k % 5) * 0.25).alias("total_line"), shape.alias("_h")).select("*", "_h.*").drop("_h")


@_query(f"""WITH {_SHAPE} SELECT fixture, side AS top_outcome, side = 'draw' AS draw_is_top, CASE WHEN ch >= ca THEN 'home' ELSE 'away' END AS directional, fl + 0 AS favourite_line, fd + 0 AS favourite_line_delta, round(od, 8) AS favourite_odds_delta,
  CASE WHEN fl < 0 THEN 'unsupported' WHEN fl = 0 THEN 'level' WHEN fl IN (0.25, 0.5) THEN 'shallow' WHEN fl IN (0.75, 1) THEN 'medium' WHEN fl IS NOT NULL THEN 'deep' END AS line_bucket, CASE WHEN tot <= 2 THEN '<=2.00' WHEN tot = 2.25 THEN '2.25' WHEN tot = 2.5 THEN '2.50' ELSE '>=2.75' END AS total_bucket FROM hw""")
def history_rows(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).select("fixture", "top_outcome", "draw_is_top", "directional", (F.col("favourite_line") + 0).alias("favourite_line"), (F.col("favourite_line_delta") + 0).alias("favourite_line_delta"), _r("favourite_odds_delta"), "line_bucket", "total_bucket")


_PROXY_SQL = {"r1_shallow_favorite_cooling": "side <> 'draw' AND abs(fl) IN (0.25, 0.5) AND round(od, 9) >= 0.03", "r2_asian_retreat": "side <> 'draw' AND round(top, 9) >= 0.45 AND round(gap, 9) >= 0.07 AND fd <= -0.25", "r3_low_total_draw_tail": "side <> 'draw' AND tot <= 2.25 AND round(cd, 9) >= 0.28 AND abs(fl) <= 0.5"}


@_query(f"""WITH {_SHAPE}, px AS ({' UNION ALL '.join(f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {c}) AS n, avg(log_loss) FILTER (WHERE {c}) AS ll, avg(hit) FILTER (WHERE {c}) AS ac FROM hw" for rule, c in _PROXY_SQL.items())}
), w AS (SELECT fixture, max(home) - min(home) AS iqr FROM q GROUP BY fixture), s AS (SELECT list_sort(list(iqr)) AS v FROM w JOIN sc USING (fixture))
SELECT rule, 'retrospective_final_closing_proxy' AS evaluability, n AS fixtures, CASE WHEN n >= 30 THEN 'available' ELSE 'insufficient_sample' END AS status, CASE WHEN n >= 30 THEN round(ll, 8) END AS log_loss, CASE WHEN n >= 30 THEN round(ac, 8) END AS accuracy, NULL::DOUBLE AS median, NULL::DOUBLE AS p75, NULL::DOUBLE AS p90 FROM px
UNION ALL SELECT rule, why, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM (VALUES {', '.join(f"('{r}', '{w}')" for r, w in score.NO_PROXY.items())}) t(rule, why)
UNION ALL SELECT 'r6_bookmaker_dispersion', 'different_metric_distribution_only', NULL, NULL, NULL, NULL, round((v[(len(v) + 1) // 2] + v[len(v) // 2 + 1]) / 2, 8), round(v[CAST(floor(0.75 * (len(v) - 1)) AS BIGINT) + 1], 8), round(v[CAST(floor(0.9 * (len(v) - 1)) AS BIGINT) + 1], 8) FROM s""")
def history_proxies(spark: SparkSession, d: str) -> DataFrame:
    wide = _quotes(spark, d).groupBy("fixture").agg((F.max("home") - F.min("home")).alias("euro_iqr"))
    found = score.history_proxies(_history(spark, d).join(wide, "fixture"), spread="euro_iqr")
    return found.select("rule", "evaluability", "fixtures", "status", *(_r(c) for c in ("log_loss", "accuracy", "median", "p75", "p90")))


@_query(f"""WITH {_SCORED}, g AS (SELECT competition, avg(log_loss) - ln(3) AS a, avg((ch - (actual = 0)::INT) ** 2 + (cd - (actual = 1)::INT) ** 2 + (ca - (actual = 2)::INT) ** 2) - 2/3 AS b FROM sc GROUP BY competition) SELECT competition, round(a, 8) AS delta_log_loss, round(b, 8) AS delta_brier FROM g""")
def uniform_deltas(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("competition").agg(*score.delta_vs_uniform()).select("competition", _r("delta_log_loss"), _r("delta_brier"))


@_query(f"""WITH {_SCORED}, b AS (SELECT competition, year(kickoff)::VARCHAR AS yr, log_loss, hit, top FROM sc UNION ALL SELECT competition, year(kickoff)::VARCHAR, ln(3), (actual = 0)::INT, 1/3 FROM sc), n AS (SELECT *, row_number() OVER () AS r FROM b)
SELECT 'uniform' AS baseline, coalesce(yr, 'all') AS year, coalesce(competition, 'all') AS competition, count(*) AS sample_size, round(avg(ln(3)), 8) AS log_loss, round(avg((actual = 0)::INT), 8) AS accuracy FROM (SELECT *, year(kickoff)::VARCHAR AS yr FROM sc) GROUP BY GROUPING SETS ((), (yr), (competition), (yr, competition))
UNION ALL SELECT 'market', coalesce(yr, 'all'), coalesce(competition, 'all'), count(*), round(avg(log_loss), 8), round(avg(hit), 8) FROM (SELECT *, year(kickoff)::VARCHAR AS yr FROM sc) GROUP BY GROUPING SETS ((), (yr), (competition), (yr, competition))""")
def baseline_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = _agreed(spark, d).select("fixture", "p").join(_fixtures(spark, d), "fixture").select("competition", F.year("kickoff").cast("string").alias("year"), F.col("fixture").alias("fixture_record_id"), "p", "actual")
    both = score.scored(score.with_baselines(rows, "p"))
    got = score.grouped_metrics(both, [("baseline",), ("baseline", "year"), ("baseline", "competition"), ("baseline", "year", "competition")])
    return got.select("baseline", "year", "competition", "sample_size", _r("log_loss"), _r("accuracy"))


@_query(f"""WITH {_SCORED}, pr AS (SELECT *, year(kickoff)::VARCHAR AS yr, {', '.join(f"1 + coalesce(sum((actual = {k} AND year(kickoff) <= 1995)::INT) OVER (PARTITION BY competition ORDER BY kickoff, fixture ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c{k}" for k in range(3))} FROM sc
), b AS (SELECT 'uniform' AS baseline, competition, yr, actual, 1/3 AS p0, 1/3 AS p1, 1/3 AS p2 FROM pr UNION ALL SELECT 'prior', competition, yr, actual, c0 / (c0 + c1 + c2), c1 / (c0 + c1 + c2), c2 / (c0 + c1 + c2) FROM pr UNION ALL SELECT 'market', competition, yr, actual, ch, cd, ca FROM pr
), m AS (SELECT baseline, competition, yr, greatest(p0, p1, p2) AS top, ((CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END) = actual)::INT AS hit, -ln(greatest(CASE actual WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-15)) AS ll,
  ((p0 - (actual = 0)::INT) ** 2 + (p0 + p1 - (actual <= 1)::INT) ** 2) / 2 AS rps FROM b
), x AS (SELECT baseline, comp, year, top, hit, ll, rps FROM m, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j), LATERAL (SELECT CASE i WHEN 0 THEN competition ELSE 'all' END AS comp, CASE j WHEN 0 THEN yr ELSE 'all' END AS year)
), g AS (SELECT baseline, comp, year, count(*) AS n, avg(ll) AS ll, avg(hit) AS ac, avg(rps) AS rps FROM x GROUP BY 1, 2, 3
), k AS (SELECT *, row_number() OVER (PARTITION BY baseline, comp, year ORDER BY top, hit) AS rn, count(*) OVER (PARTITION BY baseline, comp, year) AS n FROM x
), bn AS (SELECT baseline, comp, year, (least(10, n) * rn - 1) // n AS bin, count(*) AS k, avg(top) AS c, avg(hit) AS h, min(n) AS n FROM k GROUP BY 1, 2, 3, 4
), e AS (SELECT baseline, comp, year, sum(k / n * abs(c - h)) AS ece FROM bn GROUP BY 1, 2, 3
), cells AS (SELECT * FROM (SELECT DISTINCT competition AS comp FROM sc UNION ALL SELECT 'all'), (VALUES ('1995'), ('1996'), ('2030'), ('all')) y(year), (VALUES ('uniform'), ('prior'), ('market')) z(baseline))
SELECT baseline, year, comp AS competition, coalesce(n, 0) AS sample_size, round(ll, 8) AS log_loss, round(rps, 8) AS rps, round(ac, 8) AS accuracy, round(ece, 6) AS ece, CASE WHEN n >= 100 THEN 'available' WHEN n > 0 THEN 'insufficient_sample' END AS conclusion
FROM cells LEFT JOIN g USING (baseline, comp, year) LEFT JOIN e USING (baseline, comp, year)""")
def baseline_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """The baseline job: uniform, prior and market forecasts for two years and one without fixtures, of each competition and of all."""
    rows = _agreed(spark, d).select("fixture", "p").join(_fixtures(spark, d), "fixture")
    prior = score.running_prior(rows, ["competition"], ["kickoff", "fixture"], "actual", F.year("kickoff") <= 1995)
    points = prior.select("competition", F.year("kickoff").cast("string").alias("year"), "p", "prior", "actual")
    got = pipelines.evaluate_baseline(points, ("1995", "1996", "2030"))
    return got.select("baseline", "year", "competition", "sample_size", _r("log_loss"), _r("rps"), _r("accuracy"), F.round("ece", 6).alias("ece"), "conclusion")


_GATES = {"fixtures": ">= 60", "span_days": ">= 300", "rule_hits": ">= 15", "first_hits": ">= 9", "second_hits": ">= 9", "residual": "<= -0.14", "relative_residual": "<= -0.2", "first_residual": "< 0", "second_residual": "< 0", "upper": "< 0", "adjusted_p": "<= 0.1"}


@_query(f"""WITH {_SCORED}, m AS (SELECT competition, year(kickoff) AS year, count(*) AS fixtures, date_diff('day', min(kickoff), max(kickoff)) AS span_days, sum(hit)::BIGINT AS rule_hits, count(*) FILTER (WHERE hit = 1 AND fixture % 2 = 0) AS first_hits, count(*) FILTER (WHERE hit = 1 AND fixture % 2 = 1) AS second_hits,
  round(avg(hit - top), 9) AS residual, round(avg(hit - top) - 0.06, 9) AS relative_residual, round(avg(hit - top + 0.1) FILTER (WHERE fixture % 2 = 0), 9) AS first_residual, round(avg(hit - top + 0.1) FILTER (WHERE fixture % 2 = 1), 9) AS second_residual, round(avg(hit - top) + 0.13, 9) AS upper, count(*) % 7 / 20 AS adjusted_p FROM sc GROUP BY 1, 2)
SELECT competition, year, array_to_string(list_filter([{', '.join(f"CASE WHEN NOT coalesce({k} {limit}, false) THEN '{k}' END" for k, limit in _GATES.items())}], lambda x: x IS NOT NULL), ',') AS failed FROM m""")
def review_gates(spark: SparkSession, d: str) -> DataFrame:
    """All conditions of a review, for each competition and year."""
    v, own = F.col("hit") - F.col("top"), lambda n: F.col("fixture") % 2 == n
    m = _scored(spark, d).groupBy("competition", F.year("kickoff").alias("year")).agg(
        F.count("*").alias("fixtures"), F.datediff(F.max("kickoff"), F.min("kickoff")).alias("span_days"), F.sum("hit").alias("rule_hits"), F.count_if((F.col("hit") == 1) & own(0)).alias("first_hits"), F.count_if((F.col("hit") == 1) & own(1)).alias("second_hits"),
        F.round(F.avg(v), 9).alias("residual"), F.round(F.avg(v) - 0.06, 9).alias("relative_residual"), F.round(F.avg(F.when(own(0), v + 0.1)), 9).alias("first_residual"), F.round(F.avg(F.when(own(1), v + 0.1)), 9).alias("second_residual"),
        F.round(F.avg(v) + 0.13, 9).alias("upper"), (F.count("*") % 7 / 20).alias("adjusted_p"),
    )
    return score.review_gate(m, fixtures=60, days=300, hits=15, batch_hits=9, residual=-0.14, relative=-0.2).select("competition", "year", F.array_join("failed", ",").alias("failed"))


_OPEN = """oc AS (SELECT fixture, book, any_value(line) AS line, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS side FROM one JOIN cs USING (fixture) GROUP BY fixture, book, ch, cd, ca)"""


@_query(f"""WITH {_D}, sg AS (SELECT o.fixture, o.book, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS side, (part % 5 - 2) * 0.01 AS dp, (line % 3 - 1) * 0.25 AS ol, (part % 3 - 1) * 0.25 AS cl, part % 4 = 0 AS lone, 2 + (line % 2) * 0.25 AS ot, 2 + (part % 2) * 0.25 AS ct FROM one o JOIN cs USING (fixture)
), fl AS (SELECT *, round(CASE side WHEN 'draw' THEN -2 * dp ELSE dp END, 12) AS dd, CASE side WHEN 'home' THEN ol - cl ELSE cl - ol END AS mv FROM sg
), st AS (SELECT *, CASE WHEN dd >= 0.015 THEN 'support' WHEN dd <= -0.015 THEN 'oppose' ELSE 'unchanged' END AS euro, CASE WHEN lone OR side = 'draw' THEN 'not_evaluable' WHEN mv >= 0.25 THEN 'confirm' WHEN mv <= -0.25 THEN 'conflict' ELSE 'flat' END AS asian, CASE WHEN abs(ct - ot) >= 0.25 THEN 'material' ELSE 'flat' END AS total FROM fl)
SELECT fixture, book, euro AS euro_signal, asian AS asian_signal, total AS total_signal, (euro = 'support' AND asian = 'conflict') OR (euro = 'oppose' AND asian = 'confirm') AS internal_conflict FROM st""")
def institution_signals(spark: SparkSession, d: str) -> DataFrame:
    """Signals of each bookmaker across three markets that are paired by name; every fourth has no handicap row."""
    q = _quotes(spark, d).withColumn("rec", F.struct("line", "part", "home", "draw", "away"))
    one = q.groupBy("fixture", "book").agg(F.max_by(F.struct("line", "part"), "rec").alias("x")).select("fixture", "book", "x.*")
    side = F.element_at(F.array(*map(F.lit, odds.SIDES)), odds.favourite("p") + 1)
    dp = (F.col("part") % 5 - 2) * 0.01
    euro = one.join(_agreed(spark, d).select("fixture", side.alias("direction")), "fixture").select("fixture", "book", "direction", F.array(dp, -2 * dp, dp).alias("delta"))
    asian = one.where("part % 4 != 0").select("fixture", "book", ((F.col("line") % 3 - 1) * 0.25).alias("opening_asian_line"), ((F.col("part") % 3 - 1) * 0.25).alias("current_asian_line"), *(F.lit(0.9).alias(f"{s}_asian_{f}") for s in ("opening", "current") for f in ("home", "away")))
    total = one.select("fixture", "book", (2 + (F.col("line") % 2) * 0.25).alias("opening_total_line"), (2 + (F.col("part") % 2) * 0.25).alias("current_total_line"))
    s = market.signals(market.pair_markets(euro, asian, total, ["fixture", "book"]), "direction")
    return s.select("fixture", "book", "euro_signal", "asian_signal", "total_signal", "internal_conflict")


# --- contracts -----------------------------------------------------------------------------------------------------


_P = """p AS (SELECT c_custkey AS k, ['observation_only', 'low', 'medium', 'high', 'none'][(c_custkey % 5 + 1)::INT] AS raw, ['observation_only', 'low', 'medium', 'high'][(c_custkey % 4 + 1)::INT] AS cap, ['observation_only', 'low', 'medium', 'high'][(c_nationkey % 4 + 1)::INT] AS fin, ['A', 'B', 'C', 'D'][(c_custkey % 7 % 4 + 1)::INT] AS tier,
  CASE WHEN c_custkey % 3 = 0 THEN 'abstained' ELSE 'published' END AS status, CASE WHEN c_custkey % 2 = 0 THEN 'provisional' ELSE 'confirmed' END AS cls, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'x' END AS grp, CASE WHEN c_custkey % 13 = 0 THEN 'zz' ELSE sha256(c_name) END AS sha, CASE WHEN c_custkey % 6 = 1 THEN ' ' ELSE c_name END AS ident, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE 'v1' END AS pol FROM customer
), r AS (SELECT *, list_position(['observation_only', 'low', 'medium', 'high'], raw) AS rr, list_position(['observation_only', 'low', 'medium', 'high'], cap) AS rc, list_position(['observation_only', 'low', 'medium', 'high'], fin) AS rf FROM p)"""


@_query(f"""WITH {_P}, v AS (SELECT k, unnest(list_filter([CASE WHEN grp IS NULL THEN 'incomplete_policy_fields' END, CASE WHEN sha = 'zz' THEN 'invalid_registry_sha256' END, CASE WHEN rr IS NULL THEN 'invalid_confidence_label' END, CASE WHEN rr IS NOT NULL AND rf > least(rr, rc) THEN 'confidence_exceeds_cap' END, CASE WHEN tier = 'C' AND rc > 2 THEN 'tier_c_cap_above_low' END,
  CASE WHEN tier = 'D' AND NOT (rc = 1 AND rf = 1 AND status = 'abstained') THEN 'tier_d_not_abstained' END, CASE WHEN cls = 'provisional' AND rf > 3 THEN 'provisional_above_medium' END, CASE WHEN status = 'published' AND trim(ident) = '' THEN 'published_without_identity' END], lambda x: x IS NOT NULL)) AS code FROM r WHERE pol IS NOT NULL) SELECT k AS prediction, code FROM v""")
def policy_violations(spark: SparkSession, d: str) -> DataFrame:
    c = _read(spark, d, "customer")
    k, labels = F.col("c_custkey"), ["observation_only", "low", "medium", "high"]
    pick = lambda of, names: F.element_at(F.array(*map(F.lit, names)), (of + 1).cast("int"))
    sha = F.when(k % 13 == 0, "zz").otherwise(F.sha2("c_name", 256))
    rows = c.select(
        k.alias("prediction"), pick(k % 5, [*labels, "none"]).alias("raw_confidence_label"), pick(k % 4, labels).alias("competition_confidence_cap"), pick(F.col("c_nationkey") % 4, labels).alias("confidence_label"), pick(k % 7 % 4, "ABCD").alias("market_evidence_tier"), F.when(k % 3 == 0, "abstained").otherwise("published").alias("status"),
        F.when(k % 2 == 0, "provisional").otherwise("confirmed").alias("classification_status"), F.when(k % 11 != 0, "x").alias("evaluation_group"), sha.alias("registry_file_sha256"), sha.alias("registry_canonical_sha256"), F.when(k % 6 == 1, " ").otherwise(F.col("c_name")).alias("identity_record_id"),
        F.when(k % 10 != 9, "v1").alias("policy_version"), F.lit("league").alias("competition_type"), F.lit("1").alias("registry_version"), F.array().cast("array<string>").alias("confidence_reasons"), F.array().cast("array<string>").alias("risk_flags"),
    )
    return contracts.violations(rows, contracts.shadow_policy(), "prediction")


@_query("""WITH r AS (SELECT c_custkey AS k, c_custkey % 7 <> 0 AS id, ['league', 'cup', 'x'][(c_custkey % 3 + 1)::INT] AS kind, ['A', 'B', 'C', 'D'][(c_custkey % 4 + 1)::INT] AS tier, ['low', 'medium', 'high'][(c_nationkey % 3 + 1)::INT] AS cap, c_acctbal > 0 AS meta, c_custkey % 9 <> 0 AS al FROM customer), v AS (
SELECT k, unnest(list_filter([CASE WHEN NOT id THEN 'competition_id' END, CASE WHEN kind = 'x' THEN 'competition_type' END, CASE WHEN tier = 'D' THEN 'market_evidence_tier' END, CASE WHEN NOT meta THEN 'profile_metadata' END, CASE WHEN tier = 'C' AND cap <> 'low' THEN 'tier_c_cap_above_low' END, CASE WHEN NOT al THEN 'name_aliases' END], lambda x: x IS NOT NULL)) AS code FROM r)
SELECT k AS record, code FROM v UNION ALL SELECT p_partkey, unnest(list_filter([CASE WHEN NOT (p_size % 10 >= 5) THEN 'policy:thresholds_not_monotone' END, CASE WHEN p_retailprice > 1500 THEN 'policy:share_out_of_range' END], lambda x: x IS NOT NULL)) FROM part""")
def registry_violations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda of, names: F.element_at(F.array(*map(F.lit, names)), (of + 1).cast("int"))
    rows = _read(spark, d, "customer").select(
        k, F.when(k % 7 == 0, "x1").otherwise(k.cast("string")).alias("competition_id"), pick(k % 3, ["league", "cup", "x"]).alias("competition_type"), pick(k % 4, "ABCD").alias("market_evidence_tier"), F.lit("confirmed").alias("classification_status"), pick(F.col("c_nationkey") % 3, ["low", "medium", "high"]).alias("confidence_cap"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("canonical_name"), F.lit("g").alias("evaluation_group"), F.lit("r").alias("classification_reason"), F.when(k % 9 == 0, F.array().cast("array<string>")).otherwise(F.array("c_name")).alias("name_aliases"),
    )
    a = contracts.violations(rows, contracts.registry_contract(("league", "cup")), "c_custkey").select(F.col("c_custkey").alias("record"), "code")
    level = lambda n, gap, spread: F.struct(n.alias("bookmakers"), gap.alias("gap"), F.lit(spread).alias("dispersion"))
    policy = _read(spark, d, "part").select("p_partkey", level(F.col("p_size") % 10, F.when(F.col("p_retailprice") > 1500, 1.5).otherwise(0.15), 0.02).alias("high"), level(F.lit(5), F.lit(0.07), 0.035).alias("medium"), F.struct(F.lit(200).alias("fixtures"), F.lit(90).alias("days")).alias("gate"))
    b = contracts.violations(policy, contracts.policy_contract(), "p_partkey").select(F.col("p_partkey").alias("record"), F.concat(F.lit("policy:"), "code").alias("code"))
    return a.unionByName(b)


@_query("""WITH r AS (SELECT o_orderkey AS k, list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'proposed_action' END, CASE WHEN o_orderkey % 7 = 0 THEN 'record_id' END, CASE WHEN o_orderkey % 11 = 0 THEN 'assessed_before_effective' END, CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 THEN 'assessed_before_cutoff' END], lambda x: x IS NOT NULL) AS m FROM orders) SELECT k AS assessment, array_to_string(m, ',') AS mismatches FROM r WHERE len(m) > 0""")
def assessment_replay(spark: SparkSession, d: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.expr("INTERVAL 1 DAY")
    o = _read(spark, d, "orders").select(k.alias("assessment"), F.col("o_orderstatus").alias("proposed_action"), F.col("o_orderdate").alias("cutoff"), (F.col("o_orderdate") - day).alias("effective_at"), "o_custkey")
    own = ids.stable_id("assessment", "assessment", "o_custkey")
    stored = o.select("*", F.when(F.col("assessment") % 7 == 0, "x").otherwise(own).alias("record_id"), F.when(F.col("assessment") % 11 == 0, F.col("cutoff") - day - day).when(F.col("assessment") % 13 == 0, F.col("cutoff") - day).otherwise(F.col("cutoff")).alias("assessed_at"))
    again = o.withColumn("proposed_action", F.when(F.col("assessment") % 5 == 0, "keep").otherwise(F.col("proposed_action")))
    checks = contracts.assessment_checks("assessment", ["assessment", "o_custkey"], "effective_at", "assessed_at", "cutoff")
    return contracts.replay(stored, again, "assessment", ["proposed_action"], checks).select("assessment", F.array_join("mismatches", ",").alias("mismatches"))


@_query("""WITH b AS (SELECT l_orderkey AS k, count(*) AS n, max(l_quantity) AS q, min(l_discount) AS dsc, bool_or(l_returnflag = 'R') AS conflict, min(l_tax) = 0 AS first, count(*) >= 2 AS core FROM lineitem GROUP BY 1), x AS (SELECT *, n >= 3 AS good, q >= 30 AS inside FROM b)
SELECT k AS batch, core AND NOT conflict AND NOT first AND inside AS strict, good AS data_complete, core AND NOT conflict AND NOT first AND inside AND good AS model_strict_eligible, array_to_string(list_sort(list_filter([CASE WHEN NOT core THEN 'core_market_incomplete' END, CASE WHEN conflict THEN 'identity_conflict' END, CASE WHEN first THEN 'first_seen_after_window' END, CASE WHEN NOT good THEN 'insufficient_normalized_rows:ouzhi' END, CASE WHEN NOT inside THEN 'outside_window_or_clock:ouzhi' END], lambda v: v IS NOT NULL)), ',') AS reasons FROM x""")
def batch_assessments(spark: SparkSession, d: str) -> DataFrame:
    t = F.lit("2026-01-01").cast("timestamp")
    g = _read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("batch")).agg(F.count("*").alias("n"), F.max("l_quantity").alias("q"), F.bool_or(F.col("l_returnflag") == "R").alias("identity_conflict"), (F.min("l_tax") == 0).alias("first_seen"))
    one = F.struct(F.col("n").cast("int").alias("valid_bookmaker_rows"), F.lit("accepted").alias("normalization_status"), (F.col("q") >= 30).alias("clock_ok"), t.alias("observed_at"))
    b = g.select("*", (F.col("n") >= 2).alias("core_market_complete"), t.alias("window_start"), t.alias("window_end"), F.create_map(F.lit("ouzhi"), one).alias("market_results"))
    return contracts.batch_assessment(b, core=("ouzhi",)).select("batch", "strict", "data_complete", "model_strict_eligible", F.array_join("ineligibility_reasons", ",").alias("reasons"))


@_query("""SELECT event_type, count(*) FILTER (WHERE event_id % 3 <> 0) AS live, count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS unknown, count(*) FILTER (WHERE event_id % 2 = 0) AS flagged FROM events GROUP BY event_type""")
def live_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of live capture, of unknown type, and with the flags of their kind."""
    k = F.col("event_id")
    e = _read(spark, d, "events").select("event_id", "event_type", F.to_json(F.struct((k % 3 == 0).alias("reprocessed"))).alias("details"), F.lit("historical").alias("research_kind"), F.lit(True).alias("research_only"), (k % 2 == 0).alias("backfill"), F.lit(False).alias("strict_backtest_eligible"), F.lit(False).alias("cutoff_eligible"))
    n = lambda df, name: df.groupBy("event_type").agg(F.count("*").alias(name))
    parts = [n(e, "_all"), n(contracts.live_only(e), "live"), n(contracts.unsupported(e, "event_type", ("click", "view")), "unknown"), n(e.where(contracts.flag_contract()), "flagged")]
    return reduce(lambda a, b: a.join(b, "event_type", "left"), parts).na.fill(0).drop("_all")


# --- as-of and versions --------------------------------------------------------------------------------------------


@_query(f"""WITH {_Q}, f AS (SELECT q.*, kickoff FROM q JOIN fx USING (fixture) WHERE observed_at <= kickoff AND fixture NOT IN (SELECT fixture FROM fx WHERE actual = 2)), b AS (SELECT fixture, arg_max((book, part, line), (observed_at, book, part, line)) AS x FROM f GROUP BY fixture)
SELECT fx.fixture, x[1] AS book FROM fx LEFT JOIN b USING (fixture)""")
def one_clock_asof(spark: SparkSession, d: str) -> DataFrame:
    """The latest quote by kickoff; fixtures with outcome 2 count as invalidated."""
    q = _quotes(spark, d).withColumn("rec", F.struct("book", "part", "line"))
    fx = _fixtures(spark, d)
    return asof.asof_join(fx, q, ["fixture"], "fixture", "kickoff", "observed_at", "rec", keep=["book"], invalid=fx.where("actual = 2")).select("fixture", "book")


_NOW = "(SELECT max(o_orderdate) FROM orders) - INTERVAL 400 DAY"


@_query(f"""WITH i AS (SELECT o_custkey AS f, o_orderkey AS rid, o_orderdate AS kick, o_orderdate - to_days((o_orderkey % 5)::INT) AS seen FROM orders), n AS (SELECT {_NOW} AS now), t(target, m) AS (VALUES ('T-24h', 1440), ('T-6h', 360)
), c AS (SELECT i.*, target, kick - to_minutes(m) AS cutoff, least(kick - to_minutes(m) + INTERVAL 10 MINUTE, kick - INTERVAL 1 MINUTE) AS deadline, now FROM i, t, n WHERE kick BETWEEN now - INTERVAL 50 HOUR AND now + INTERVAL 49 HOUR
), k AS (SELECT *, row_number() OVER (PARTITION BY f, target ORDER BY seen DESC, rid DESC) AS rn FROM c WHERE seen <= cutoff) SELECT f AS fixture_id, target, rid AS record_id FROM k WHERE rn = 1 AND cutoff <= now AND now <= deadline""")
def open_targets(spark: SparkSession, d: str) -> DataFrame:
    """What may be published at a time: targets by the identity that was known at their own cutoff. Every order of a customer is a version of one fixture."""
    o = _read(spark, d, "orders")
    now = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    i = o.select(F.col("o_custkey").alias("fixture_id"), F.col("o_orderkey").alias("record_id"), F.col("o_orderdate").alias("kickoff_at"), (F.col("o_orderdate") - F.make_dt_interval((F.col("o_orderkey") % 5).cast("int"))).alias("observed_at"))
    t = pipelines.identity_targets(i, asof.targets(spark, ("T-24h", "T-6h")), F.lit(now) - F.expr("INTERVAL 400 DAY"))
    return t.select("fixture_id", "target", "record_id")


@_query("""WITH a AS (SELECT event_id AS r, user_id AS k, ['T-24h', 'T-6h', 'T-60m', 'T-10m'][(event_id % 4 + 1)::INT] AS t, event_id % 3 AS pol, ts FROM events), p AS (SELECT *, CASE t WHEN 'T-6h' THEN 'T-24h' WHEN 'T-60m' THEN 'T-6h' WHEN 'T-10m' THEN 'T-60m' END AS pt FROM a)
SELECT p.r AS record_id, arg_max(x.r, (x.ts, x.r)) AS previous_record FROM p LEFT JOIN a x ON x.k = p.k AND x.t = p.pt AND x.pol = p.pol AND x.ts < p.ts GROUP BY p.r""")
def previous_targets(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    a = _read(spark, d, "events").select(k.alias("record_id"), "user_id", F.element_at(F.array(*map(F.lit, ("T-24h", "T-6h", "T-60m", "T-10m"))), (k % 4 + 1).cast("int")).alias("target"), (k % 3).alias("policy"), F.col("ts").alias("cutoff"))
    return asof.previous_target(a, "user_id", "target", "cutoff", "record_id", "policy").select("record_id", "previous_record")


@_query("""SELECT o_orderkey AS batch, CASE l_linenumber % 2 WHEN 0 THEN 'ouzhi' ELSE 'yazhi' END AS market, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_suppkey = CASE l_linenumber % 2 WHEN 0 THEN o_custkey % 50 ELSE o_custkey % 70 END GROUP BY 1, 2""")
def batch_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the snapshots that a batch names for two markets; a snapshot is an order and a supplier."""
    snap = lambda m: F.struct(F.concat_ws("-", "o_orderkey", F.col("o_custkey") % m).alias("snapshot_record_id"))
    b = _read(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), F.create_map(F.lit("ouzhi"), snap(50), F.lit("yazhi"), snap(70)).alias("market_results"))
    l = _read(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_suppkey").alias("source_snapshot_record_id"), F.when(F.col("l_linenumber") % 2 == 0, "ouzhi").otherwise("yazhi").alias("market"))
    return asof.batch_rows(b, l).groupBy(F.col("batch_record_id").alias("batch"), "market").agg(F.count("*").alias("n"))


@_query("""WITH e AS (SELECT l_orderkey AS f, l_linenumber AS t, greatest(l_shipdate, l_shipdate + to_days((l_suppkey % 5)::INT)) AS core, l_partkey AS done, l_suppkey AS r, l_quantity > 10 AS ok FROM lineitem), x AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY core DESC, done DESC, r DESC) AS rn FROM e WHERE ok) SELECT f AS fixture, core AS core_observed_at, done, r AS record FROM x WHERE rn = 1""")
def eligible_batches(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("fixture"), F.col("l_shipdate").alias("a"), (F.col("l_shipdate") + F.make_dt_interval((F.col("l_suppkey") % 5).cast("int"))).alias("b"), F.col("l_partkey").alias("done"), F.col("l_suppkey").alias("record"), "l_quantity")
    return versions.eligible_batch(e, ["fixture"], ["a", "b"], "done", "record", F.col("l_quantity") > 10).select("fixture", "core_observed_at", "done", "record")


@_query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC) AS rn FROM lineitem WHERE l_returnflag <> 'R') SELECT l_orderkey AS snapshot, l_linenumber AS version, l_partkey AS record FROM x WHERE rn = 1""")
def current_derivations(spark: SparkSession, d: str) -> DataFrame:
    l = _read(spark, d, "lineitem")
    return versions.current_derivation(l, ["l_orderkey"], "l_linenumber", "l_shipdate", "l_partkey", F.col("l_returnflag") != "R").select(F.col("l_orderkey").alias("snapshot"), F.col("l_linenumber").alias("version"), F.col("l_partkey").alias("record"))


@_query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) SELECT user_id, event_type, event_id FROM x WHERE rn = 1""")
def retried_batches(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").withColumn("batch", F.concat_ws("-", "user_id", "event_type"))
    return versions.retry_merge(e, "batch", "ts", "event_id").select("user_id", "event_type", "event_id")


@_query("""WITH c AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_suppkey AS s, l_partkey AS p, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS a, l_linestatus AS b, (l_linenumber % 2 = 0)::INT + 1 AS sc FROM lineitem), w AS (SELECT *, first_value(a) OVER z AS ba, first_value(b) OVER z AS bb FROM c WINDOW z AS (PARTITION BY k ORDER BY sc DESC, ln, s, p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT k AS snapshot, count(*) FILTER (WHERE a IS NOT NULL AND a IS DISTINCT FROM ba) AS flag_differs, count(*) FILTER (WHERE b IS DISTINCT FROM bb) AS status_differs FROM w GROUP BY k""")
def canonical_observations(spark: SparkSession, d: str) -> DataFrame:
    l = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"))
    c = versions.canonical_observation(l, ["l_orderkey"], ["flag", "status"], ["l_linenumber", "l_suppkey", "l_partkey"])
    has = lambda f: F.count_if(F.array_contains("mismatches", f))
    return c.groupBy(F.col("l_orderkey").alias("snapshot")).agg(has("flag").alias("flag_differs"), has("status").alias("status_differs"))


@_query("""WITH x AS (SELECT doc_id, source, lang, n_chars, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS rn FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL AND trim(text, ' ') <> '' AND NOT contains(text, chr(65533)) AND NOT regexp_matches(text, 'Ã.|Â.|â€')) SELECT source, lang, doc_id FROM x WHERE rn = 1""")
def latest_valid_texts(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents")
    return versions.latest_valid(docs, ["source", "lang"], ["text", "n_chars"], "n_chars", "doc_id").select("source", "lang", "doc_id")


# --- evidence and reports ------------------------------------------------------------------------------------------


@_query("""WITH j AS (SELECT o_orderkey AS r, o.o_custkey AS cand, c.c_custkey AS c, n.n_nationkey AS o, rg.r_regionkey AS k, c_acctbal, n_regionkey FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 11 <> 0) c ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0) n ON c_nationkey = n_nationkey LEFT JOIN region rg ON n_regionkey = r_regionkey
), x AS (SELECT r, list_filter([CASE WHEN c IS NULL THEN 'missing_candidate' END, CASE WHEN c IS NOT NULL AND c % 4 = 0 THEN 'score_mismatch' END, CASE WHEN o IS NULL THEN 'missing_observation' END, CASE WHEN k IS NULL THEN 'missing_link' END, CASE WHEN k = 2 THEN 'link_mismatch' END, CASE WHEN k IS NULL OR k = 3 THEN 'missing_inventory' END, CASE WHEN k = 1 THEN 'incomplete_inventory' END, CASE WHEN k IS NULL OR k IN (3, 4) THEN 'missing_accepted_scope' END], lambda v: v IS NOT NULL) AS c FROM j)
SELECT r AS result_id, array_to_string(c, ',') AS codes, CASE WHEN len(c) = 0 THEN 'passed' ELSE 'failed' END AS status FROM x""")
def evidence_chains(spark: SparkSession, d: str) -> DataFrame:
    """Orders as results, customers as candidates, nations as observations, regions as links, inventories and scopes."""
    none, key = F.lit(None).cast("int"), F.col("r_regionkey")
    r = _read(spark, d, "region")
    results = _read(spark, d, "orders").select(F.col("o_orderkey").alias("result_id"), F.lit(1).alias("fixture_id"), F.lit(1).alias("home_goals"), F.lit(0).alias("away_goals"), F.col("o_custkey").alias("candidate_id"))
    cand = _read(spark, d, "customer").where("c_custkey % 11 != 0").select(F.col("c_custkey").alias("candidate_id"), F.col("c_nationkey").alias("observation_id"), F.when(F.col("c_custkey") % 4 == 0, 9).otherwise(1).alias("home_goals"), F.lit(0).alias("away_goals"))
    obs = _read(spark, d, "nation").where("n_nationkey % 6 != 0").select(F.col("n_nationkey").alias("observation_id"), F.col("n_regionkey").alias("link_id"))
    links = r.select(key.alias("link_id"), F.when(key == 3, none).otherwise(key).alias("inventory_id"), F.when(key == 2, 7).otherwise(1).alias("fixture_id"))
    inv = r.select(key.alias("inventory_id"), key.alias("scope_id"), (key != 1).alias("complete"))
    got = evidence.chain_audit(results, cand, obs, links, inv, r.select(key.alias("scope_id"), (key != 4).alias("accepted")))
    return got.select("result_id", F.array_join("codes", ",").alias("codes"), "status")


@_query("""SELECT o_orderkey, coalesce(c_mktsegment, p_brand, 'unknown') AS format FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM part WHERE p_partkey % 2 = 0) ON o_custkey = p_partkey""")
def looked_up(spark: SparkSession, d: str) -> DataFrame:
    by_id = _read(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("format"))
    by_name = _read(spark, d, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("format"))
    o = _read(spark, d, "orders").withColumn("name", F.col("o_custkey"))
    return evidence.lookup(o, by_id, by_name, "o_custkey", "name", "format", "unknown").select("o_orderkey", "format")


@_query("""WITH s AS (SELECT event_type AS signal, max(ts) AS last FROM events WHERE event_type <> 'error' GROUP BY 1), l AS (SELECT DISTINCT event_type AS signal FROM events), n AS (SELECT min(ts) + (max(ts) - min(ts)) / 1 + INTERVAL 2 HOUR AS now FROM events), j AS (SELECT l.signal, CAST(epoch(date_trunc('second', now)) AS BIGINT) - CAST(epoch(date_trunc('second', last)) AS BIGINT) AS age FROM n, l LEFT JOIN s USING (signal))
SELECT signal, age, CASE WHEN age IS NULL OR age > 100000 THEN 'failed' WHEN age < 0 THEN 'in_future' WHEN age > 7300 THEN 'warning' ELSE 'ok' END AS status FROM j""")
def stale_signals(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    now = e.agg((F.max("ts") + F.expr("INTERVAL 2 HOURS")).alias("n")).first()["n"]
    limits = e.select(F.col("event_type").alias("signal")).distinct().select("signal", F.lit(7300).alias("warn_after"), F.lit(100000).alias("fail_after"))
    return evidence.staleness(e.where("event_type != 'error'").select(F.col("event_type").alias("signal"), "ts"), F.lit(now), limits)


@_query("""WITH x AS (SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN (event_id % 5) * 30 END AS d FROM events) SELECT event_id, d::BIGINT AS drift, CASE WHEN d > 60 THEN CASE WHEN event_type = 'error' THEN 'critical' ELSE 'stale_warning' END WHEN d IS NULL AND event_id % 2 = 1 THEN 'stale_warning' ELSE 'ok' END AS status FROM x""")
def clock_drift(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    e = _read(spark, d, "events").withColumn("server", F.when(k % 7 != 0, F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k % 5 * 30).cast("decimal(18,6)"))))
    return evidence.clock_drift(e, "ts", "server", 60, F.col("event_type") == "error", k % 2 == 0).select("event_id", "drift", "status")


@_query("""SELECT event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS status, count(*) AS n, count(DISTINCT user_id) AS fixtures FROM events GROUP BY 1, 2""")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").withColumn("status", F.when(F.col("value") > 50, "high").otherwise("low"))
    return reports.status_counts(e, "event_type", "status", "user_id")


@_query("""WITH g AS (SELECT l_orderkey AS k, count(DISTINCT CASE WHEN l_discount > 0.02 THEN l_suppkey END) AS v, count(*) FILTER (WHERE l_returnflag <> 'R') AS b, count(*) FILTER (WHERE l_linestatus = 'F') AS t, count(*) FILTER (WHERE l_tax > 0.07) AS e FROM lineitem GROUP BY 1)
SELECT k AS snapshot, v AS valid_bookmakers, b AS bookmaker_rows, array_to_string(list_filter([CASE WHEN b = 0 THEN 'no_bookmaker_rows' END, CASE WHEN e > 0 THEN 'line_parse_failures' END, CASE WHEN t < b THEN 'missing_source_times' END], lambda x: x IS NOT NULL), ',') AS reasons, CASE WHEN b = 0 THEN 'rejected' ELSE 'accepted' END AS status FROM g""")
def normalization_quality(spark: SparkSession, d: str) -> DataFrame:
    l = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("snapshot"), F.col("l_suppkey").alias("book"), "l_discount", F.when(F.col("l_returnflag") != "R", "bookmaker").otherwise("summary").alias("row_role"), F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("source_time"), F.when(F.col("l_tax") > 0.07, "missing").alias("line_error"))
    q = reports.normalization_quality(l, "snapshot", "book", F.col("l_discount") > 0.02, "source_time", "line_error")
    return q.select("snapshot", "valid_bookmakers", "bookmaker_rows", F.array_join("quality_reasons", ",").alias("reasons"), "status")


@_query("""WITH s AS (SELECT o_orderpriority AS c, ['ouzhi', 'yazhi', 'daxiao'][(o_orderkey % 3 + 1)::INT] AS m, o_custkey % 9 AS r, o_custkey % 2 AS f, o_custkey % 5 AS t FROM orders), g AS (SELECT c, m, count(*) AS snapshots, sum(r)::BIGINT AS n_rows, sum(CASE WHEN m <> 'ouzhi' THEN r END) AS ln, sum(CASE WHEN m <> 'ouzhi' THEN f END) AS bad, sum(t) AS tm FROM s GROUP BY GROUPING SETS ((c, m), (m)))
SELECT coalesce(c, 'all') AS competition, m AS market, snapshots, n_rows, round((ln - bad) / ln, 6) AS parse_success_rate, round(tm / n_rows, 6) AS time_coverage FROM g""")
def market_quality(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_custkey")
    s = _read(spark, d, "orders").select(F.col("o_orderpriority").alias("competition"), F.element_at(F.array(*map(F.lit, ("ouzhi", "yazhi", "daxiao"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("market"), (k % 9).alias("row_count"), (k % 2).alias("line_failures"), (k % 5).alias("timed_rows"))
    return reports.market_quality(s, ["competition"], "market")


@_query("""WITH w AS (SELECT max(o_orderdate) - INTERVAL 300 DAY AS a, max(o_orderdate) - INTERVAL 200 DAY AS b FROM orders), fx AS (SELECT o_orderkey AS k, o_orderdate AS t FROM orders, w WHERE o_orderdate >= a - INTERVAL 24 HOUR AND o_orderdate < b - INTERVAL 24 HOUR AND o_orderkey % 17 <> 0), s AS (SELECT l_orderkey AS k, min(l_shipdate) AS seen FROM lineitem GROUP BY 1), v AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07)
), j AS (SELECT fx.k, seen <= t + INTERVAL 24 HOUR AS c, v.k IS NOT NULL AS v FROM fx LEFT JOIN s USING (k) LEFT JOIN v USING (k)) SELECT count(*) AS fixtures, count(*) FILTER (WHERE c) AS candidates, count(*) FILTER (WHERE v) AS verified, round(count(*) FILTER (WHERE c) / count(*), 6) AS candidate_rate, round(count(*) FILTER (WHERE v) / count(*), 6) AS verified_rate FROM j""")
def result_coverage(spark: SparkSession, d: str) -> DataFrame:
    o, l = _read(spark, d, "orders"), _read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "fixture_id")
    last = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    fx = o.select(F.col("o_orderkey").alias("fixture_id"), F.col("o_orderdate").alias("kickoff_at"))
    start, end = (F.lit(last) - F.expr(f"INTERVAL {n} DAYS") for n in (300, 200))
    return reports.result_coverage(fx, l.select("fixture_id", F.col("l_shipdate").alias("observed_at")), l.where("l_returnflag = 'A'"), l.where("l_tax > 0.07"), fx.where("fixture_id % 17 = 0"), start, end)


@_query("""WITH p AS (SELECT l_orderkey AS b, l_linenumber AS page, 4 AS total, l_returnflag <> 'R' AS ok FROM lineitem) SELECT b AS batch_id, count(DISTINCT page) AS fetched, count(DISTINCT page) = 4 AND bool_and(ok) AS complete FROM p GROUP BY b""")
def inventories(spark: SparkSession, d: str) -> DataFrame:
    p = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("batch_id"), F.col("l_linenumber").alias("page"), F.lit(4).alias("total_pages"), (F.col("l_returnflag") != "R").alias("ok"))
    return reports.inventory_complete(p).select("batch_id", "fetched", "complete")


@_query("""SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN o_totalprice < 50000 THEN 'small' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END], lambda x: x IS NOT NULL)) AS reason FROM orders) GROUP BY reason""")
def reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    r = rules.codes((F.col("o_totalprice") < 50000, "small"), (F.col("o_orderstatus") == "P", "pending"))
    return reports.histogram(_read(spark, d, "orders").select(r.alias("reasons")), "reasons")


_DAY = """r AS (SELECT event_id, ts, ['discovery_poll', 'http_request', 'parser', 'result_candidate', 'market_capture', 'snapshot_batch'][(event_id % 6 + 1)::INT] AS kind, CASE event_id % 6 WHEN 0 THEN CASE WHEN value > 20 THEN 'full' ELSE 'partial' END WHEN 3 THEN CASE WHEN value > 20 THEN 'success' ELSE 'missing' END ELSE CASE WHEN value > 20 THEN 'success' ELSE 'failure' END END AS status, event_type AS comp, 'T-' || user_id % 3 AS cut FROM events WHERE event_id % 10 <> 3
), dy AS (SELECT *, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day FROM r)"""


def _live(spark: SparkSession, d: str) -> DataFrame:
    k, good = F.col("event_id"), F.col("value") > 20
    kinds = ("discovery_poll", "http_request", "parser", "result_candidate", "market_capture", "snapshot_batch")
    status = F.when(k % 6 == 0, F.when(good, "full").otherwise("partial")).when(k % 6 == 3, F.when(good, "success").otherwise("missing")).otherwise(F.when(good, "success").otherwise("failure"))
    return _read(spark, d, "events").select(F.col("ts").alias("occurred_at"), F.element_at(F.array(*map(F.lit, kinds)), (k % 6 + 1).cast("int")).alias("event_type"), status.alias("status"), F.col("event_type").alias("competition"), F.concat(F.lit("T-"), F.col("user_id") % 3).alias("cutoff"), F.when(k % 10 == 3, "reprocess").alias("origin"))


@_query(f"""WITH {_DAY} SELECT day, count(*) AS events, round(count(*) FILTER (WHERE kind = 'discovery_poll' AND status = 'full') / nullif(count(*) FILTER (WHERE kind = 'discovery_poll'), 0), 6) AS discovery_full_rate, round(count(*) FILTER (WHERE kind = 'http_request' AND status = 'success') / nullif(count(*) FILTER (WHERE kind = 'http_request'), 0), 6) AS http_acquisition_rate,
  round(count(*) FILTER (WHERE kind = 'parser' AND status = 'success') / nullif(count(*) FILTER (WHERE kind = 'parser'), 0), 6) AS parser_rate, round(count(*) FILTER (WHERE kind = 'result_candidate' AND status = 'success') / nullif(count(*) FILTER (WHERE kind = 'result_candidate'), 0), 6) AS result_candidate_rate FROM dy GROUP BY day""")
def daily_rates(spark: SparkSession, d: str) -> DataFrame:
    return reports.daily_report(_live(spark, d), origin="origin")[0]


@_query(f"""WITH {_DAY}, c AS (SELECT day, 'event' AS section, kind AS name, status FROM dy UNION ALL SELECT day, 'market', comp, status FROM dy WHERE kind = 'market_capture' UNION ALL SELECT day, 'cutoff', cut, status FROM dy WHERE kind = 'snapshot_batch'), w AS (SELECT max(day) AS m FROM dy)
SELECT section, name, status, count(*) AS n, count(DISTINCT day) AS days FROM c, w WHERE day >= m - 7 AND day < m GROUP BY ALL""")
def weekly_counts(spark: SparkSession, d: str) -> DataFrame:
    """The last seven whole days of the daily counts."""
    counts = reports.daily_report(_live(spark, d), origin="origin")[1]
    last = counts.agg(F.max("day").alias("m")).first()["m"]
    return reports.window_report(counts, F.date_sub(F.lit(last), 7), F.lit(last))


# --- streams, publication, models ----------------------------------------------------------------------------------


@_query("""WITH c AS (SELECT o_orderkey AS f, o_orderdate AS k, (SELECT max(o_orderdate) FROM orders) - INTERVAL 2 DAY AS now, unnest([3, 6, 24, 48, 72, 96, 120, 144, 168]) AS h FROM orders) SELECT h AS hours, CASE WHEN now > k + INTERVAL 168 HOUR THEN 'expired' WHEN now >= k + to_hours(h) THEN 'due' ELSE 'pending' END AS status, count(*) AS n FROM c GROUP BY 1, 2""")
def planned_checks(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders")
    last = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    c = states.result_checks(o.select("o_orderkey", F.col("o_orderdate").alias("kick")), "kick", F.lit(last) - F.expr("INTERVAL 2 DAYS"))
    return c.withColumn("hours", ((F.unix_timestamp("at") - F.unix_timestamp("kick")) / 3600).cast("int")).groupBy("hours", "status").agg(F.count("*").alias("n"))


@_query("""WITH v AS (SELECT o_custkey AS f, o_orderkey AS v, o_orderdate AS k, o_orderdate - INTERVAL 8 HOUR AS seen FROM orders), t(target, m) AS (VALUES ('T-12h', 720), ('T-6h', 360)) SELECT f AS fixture, v AS version, target, CASE WHEN k - to_minutes(m) < seen THEN 'missed_before_discovery' ELSE 'pending' END AS status, v < max(v) OVER (PARTITION BY f) AS superseded FROM v, t""")
def planned_targets(spark: SparkSession, d: str) -> DataFrame:
    i = _read(spark, d, "orders").select(F.col("o_custkey").alias("fixture"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("kick"), (F.col("o_orderdate") - F.expr("INTERVAL 8 HOURS")).alias("seen"))
    return states.superseded(states.plan(i, asof.targets(spark, ("T-12h", "T-6h")), "seen", "kick"), ["fixture"], "version").select("fixture", "version", "target", "status", "superseded")


@_query("""WITH c AS (SELECT user_id, event_type, sha256('publication|' || user_id || '|' || event_type) AS id FROM events GROUP BY 1, 2) SELECT user_id, event_type, id AS publication_id FROM c WHERE NOT (user_id % 3 = 0 AND event_type = 'click')""")
def unpublished(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").select("user_id", "event_type")
    done = e.where("user_id % 3 = 0 AND event_type = 'click'").distinct().select(ids.stable_id("publication", "user_id", "event_type").alias("publication_id"))
    return states.publish_once(e, done, ["user_id", "event_type"]).select("user_id", "event_type", "publication_id")


@_query("""SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2""")
def claimed_once(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").select(F.concat_ws("|", "user_id", "event_type").alias("key"), "ts", "event_id", "user_id", "event_type")
    first = e.join(e.groupBy("key").agg(F.min("ts").alias("ts")), ["key", "ts"]).groupBy("key", "ts", "user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return states.claim_once(e.join(first.select("event_id"), "event_id", "left_semi").unionByName(e.join(first.select("event_id"), "event_id", "left_anti")), "key", "ts", "1 day").select("user_id", "event_type", "event_id")


@_query("""WITH a AS (SELECT o_orderpriority AS channel, o_orderkey AS r, o_orderdate AS f, lead(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS u FROM orders), n AS (SELECT max(o_orderdate) - INTERVAL 500 DAY AS now FROM orders), x AS (SELECT a.*, row_number() OVER (PARTITION BY channel ORDER BY f DESC, r DESC) AS rn FROM a, n WHERE f <= now AND (u IS NULL OR u > now))
SELECT channel, 'm-' || r AS model_version, sha256('research_model_version|m|m-' || r) AS model_record_id FROM x WHERE rn = 1""")
def running_models(spark: SparkSession, d: str) -> DataFrame:
    """The model that each channel runs at a time; every order activates one until the next of its priority."""
    from pyspark.sql import Window

    o = _read(spark, d, "orders")
    last = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    until = F.lead("o_orderdate").over(Window.partitionBy("o_orderpriority").orderBy("o_orderdate", "o_orderkey"))
    a = o.select(F.col("o_orderpriority").alias("channel"), F.lit("m").alias("model_key"), F.concat(F.lit("m-"), "o_orderkey").alias("model_version"), F.col("o_orderdate").alias("activated_at"), F.col("o_orderdate").alias("active_from"), until.alias("active_until"), F.lit("active").alias("status"), F.col("o_orderkey").alias("record_id"))
    a = a.withColumn("model_record_id", ids.stable_id("research_model_version", "model_key", "model_version"))
    return models.active_models(a, F.lit(last) - F.expr("INTERVAL 500 DAYS")).select("channel", "model_version", "model_record_id")


# --- rules and reviews ---------------------------------------------------------------------------------------------


@_query("""SELECT o_orderkey AS fixture, CASE WHEN o_orderkey % 19 = 0 THEN 'missing_identity' WHEN o_orderkey % 7 = 0 THEN 'competition_profile_conflict' WHEN o_orderkey % 5 = 0 THEN 'unregistered_competition' WHEN n IS NULL THEN 'missing_snapshot' WHEN n < 3 THEN 'insufficient_bookmakers' END AS reason,
  array_to_string(list_sort(list_filter([CASE WHEN n IS NULL THEN 'missing_snapshot' END, CASE WHEN o_orderkey % 7 = 0 THEN 'reference_conflict' END, CASE WHEN o_custkey % 6 = 0 THEN 'hash_mismatch' END, CASE WHEN o_custkey % 4 = 0 THEN 'observed_after_cutoff' END, CASE WHEN coalesce(n, 0) < 3 THEN 'insufficient_bookmakers:ouzhi' END], lambda x: x IS NOT NULL)), ',') AS hard
FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def abstentions(spark: SparkSession, d: str) -> DataFrame:
    n = _read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct("l_suppkey").alias("bookmakers"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = _read(spark, d, "orders").join(n, "o_orderkey", "left").select(
        k.alias("fixture"), "bookmakers", F.when(k % 19 != 0, "i").alias("identity_record_id"), (k % 7 == 0).alias("conflict"), (k % 7 == 0).alias("reference_conflict"), (k % 5 == 0).alias("unregistered"), F.when(F.col("bookmakers").isNotNull(), "s").alias("snapshot_record_id"),
        F.when(F.col("bookmakers").isNotNull(), F.create_map(F.lit("ouzhi"), F.col("bookmakers"))).otherwise(F.create_map().cast("map<string,bigint>")).alias("bookmaker_counts"), F.sha2(k.cast("string"), 256).alias("stored_sha256"), F.sha2(F.when(c % 6 == 0, F.lit("other")).otherwise(k.cast("string")), 256).alias("content_sha256"),
        F.col("o_orderdate").alias("cutoff"), F.when(c % 4 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col("o_orderdate")).alias("observed_at"), F.col("o_orderdate").alias("completed_at"), F.col("o_orderdate").alias("available_at"),
    )
    return o.select("fixture", rules.abstention(o).alias("reason"), F.array_join(rules.hard_reasons(markets=("ouzhi",)), ",").alias("hard"))


@_query("""WITH s AS (SELECT l_orderkey AS f, l_suppkey % 3 AS src, CASE WHEN l_linenumber % 4 <> 0 THEN l_partkey % 2 END AS h, l_tax < 0.08 AS id, l_returnflag <> 'R' AS reg FROM lineitem), g AS (SELECT f, count(DISTINCT h) AS scores, bool_and(id) AS id, bool_and(reg) AS reg, count(DISTINCT CASE WHEN h IS NOT NULL THEN src END) AS scored FROM s GROUP BY f
), r AS (SELECT f, CASE WHEN NOT id THEN 'identity_conflict' WHEN scores > 1 THEN 'score_conflict' WHEN scored < 2 THEN 'second_source_unavailable' WHEN NOT reg THEN 'result_scope_ambiguous' END AS reason FROM g) SELECT f AS fixture_id, CASE WHEN reason IS NULL THEN 'verified' ELSE 'isolated' END AS status, reason FROM r""")
def verified_results(spark: SparkSession, d: str) -> DataFrame:
    s = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("fixture_id"), (F.col("l_suppkey") % 3).alias("source"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_partkey") % 2).alias("home_goals"), F.lit(0).alias("away_goals"), (F.col("l_tax") < 0.08).alias("identity_ok"), F.when(F.col("l_returnflag") != "R", "regular_time_only").otherwise("cup").alias("format"))
    return rules.verify_results(s).select("fixture_id", "status", "reason")


@_query("""WITH o AS (SELECT o_orderkey AS f, o_custkey % 4 AS h, o_orderstatus = 'P' AS cancelled, o_orderkey % 9 <> 0 AS mapped, CASE WHEN o_orderkey % 8 = 0 THEN 'x' ELSE 'regular_time_90' END AS scope FROM orders), c AS (SELECT o_orderkey AS f, CASE WHEN o_custkey % 3 = 0 THEN 9 ELSE o_custkey % 4 END AS h FROM orders WHERE o_custkey % 10 <> 0), a AS (SELECT o_orderkey AS f, CASE WHEN o_custkey % 7 = 0 THEN 8 ELSE o_custkey % 4 END AS h FROM orders WHERE o_custkey % 2 = 0)
SELECT o.f AS fixture_id, CASE WHEN cancelled THEN 'cancelled' WHEN NOT mapped THEN 'unmapped' WHEN a.h <> o.h THEN 'conflict_with_accepted' WHEN scope = 'x' THEN 'scope_difference' WHEN c.h IS NULL OR c.h <> o.h THEN 'score_mismatch' ELSE 'verified' END AS status FROM o LEFT JOIN c USING (f) LEFT JOIN a USING (f)""")
def reconciled_results(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = _read(spark, d, "orders")
    goals = lambda h: (h.alias("home_goals"), F.lit(0).alias("away_goals"))
    official = o.select(k.alias("fixture_id"), *goals(c % 4), (F.col("o_orderstatus") == "P").alias("cancelled"), (k % 9 != 0).alias("mapped"), F.when(k % 8 == 0, "x").otherwise("regular_time_90").alias("scope"))
    cand = o.where("o_custkey % 10 != 0").select(k.alias("fixture_id"), *goals(F.when(c % 3 == 0, F.lit(9).cast("long")).otherwise(c % 4)))
    done = o.where("o_custkey % 2 = 0").select(k.alias("fixture_id"), *goals(F.when(c % 7 == 0, F.lit(8).cast("long")).otherwise(c % 4)))
    return rules.reconcile(official, cand, done).select("fixture_id", "status")


@_query("""WITH j AS (SELECT o_orderkey AS f, CASE WHEN o_orderkey % 13 = 0 THEN 'already_verified' WHEN o_orderkey % 10 = 0 THEN 'missing_candidate' WHEN o_orderstatus = 'P' THEN 'not_finished' WHEN o_custkey % 6 = 0 THEN 'inconsistent_analysis' WHEN o_custkey % 5 = 0 THEN 'score_mismatch' END AS reason FROM orders) SELECT f AS fixture_id, reason, (SELECT count(reason) = 0 FROM j) AS accepted FROM j""")
def attested_results(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = _read(spark, d, "orders")
    asked = o.select(k.alias("fixture_id"), F.lit(1).alias("home_goals"), F.lit(0).alias("away_goals"))
    cand = o.where("o_orderkey % 10 != 0").select(k.alias("fixture_id"), F.when(c % 5 == 0, 2).otherwise(1).alias("home_goals"), F.lit(0).alias("away_goals"), F.when(c % 6 == 0, "failed").otherwise("passed").alias("analysis_consistency"), (F.col("o_orderstatus") != "P").alias("finished"))
    return rules.attestation(asked, cand, o.where("o_orderkey % 13 = 0").select(k.alias("fixture_id"))).select("fixture_id", "reason", "accepted")


#: A part is a fixture here, so that markets have many bookmakers; an order is a bookmaker's name.
_ROWS = """mr AS (
  SELECT l_partkey AS f, 'b' || l_orderkey % 499 AS b, l_linenumber AS ln, l_orderkey AS ok, l_quantity AS qt, ['ouzhi', 'yazhi', 'daxiao', 'ouzhi'][(l_linenumber % 4 + 1)::INT] AS m, 1.5 + l_discount * 10 AS oh, 3 + l_tax * 5 AS od, 2.2 + l_quantity / 20 AS oa,
    (l_partkey % 3 - 1) * 0.12 + (l_suppkey % 5 - 2) * 0.05 AS st, (l_partkey % 4) * -0.25 AS ol, (l_partkey % 4) * -0.25 + (l_partkey % 5 - 2) * 0.25 + (l_suppkey % 3 - 1) * 0.25 AS kl, 2 + (l_suppkey % 3) * 0.25 + (l_partkey % 2) * 0.25 AS tl, l_shipdate, l_tax, l_discount FROM lineitem
), nw AS (SELECT *, oh + st AS kh, oa - st AS ka FROM mr
), gp AS (SELECT f, m, b, count(DISTINCT CASE m WHEN 'ouzhi' THEN (oh, od, oa, kh, ka, 0.0::DOUBLE) WHEN 'yazhi' THEN (oh, ol::DOUBLE, oa, kh, ka, kl::DOUBLE) ELSE (oh, tl::DOUBLE, oa, kh, ka, 0.0::DOUBLE) END) AS v, arg_min((oh, od, oa, kh, ka, ol::DOUBLE, kl::DOUBLE, tl::DOUBLE), (ln, ok, qt)) AS x FROM nw GROUP BY f, m, b
), ok AS (SELECT f, m, b, x[1] AS oh, x[2] AS od, x[3] AS oa, x[4] AS kh, x[5] AS ka, x[6] AS ol, x[7] AS kl, x[8] AS tl FROM gp WHERE v = 1
), ct AS (SELECT f, count(*) FILTER (WHERE m = 'ouzhi') AS n1, count(*) FILTER (WHERE m = 'yazhi') AS n2, count(*) FILTER (WHERE m = 'daxiao') AS n3 FROM ok GROUP BY f
), al AS (SELECT DISTINCT f FROM mr
), cf AS (SELECT f, list('duplicate_company_conflict:' || m || ':' || b) AS c FROM gp WHERE v > 1 GROUP BY f
), e AS (SELECT f, b, oh, oa, kh, ka, (1/oh)/(1/oh+1/od+1/oa) AS qh, (1/od)/(1/oh+1/od+1/oa) AS qd, (1/oa)/(1/oh+1/od+1/oa) AS qa, (1/kh)/(1/kh+1/od+1/ka) AS ph, (1/od)/(1/kh+1/od+1/ka) AS pd, (1/ka)/(1/kh+1/od+1/ka) AS pa FROM ok WHERE m = 'ouzhi'
), md AS (SELECT f, count(*) AS n, median(ph) AS mh, median(pd) AS mdr, median(pa) AS ma FROM e GROUP BY f
), ds AS (SELECT e.f, greatest(median(abs(ph - mh)), median(abs(pd - mdr)), median(abs(pa - ma))) AS disp FROM e JOIN md USING (f) GROUP BY e.f
), cs AS (SELECT f, n, mh / (mh + mdr + ma) AS ch, mdr / (mh + mdr + ma) AS cd, ma / (mh + mdr + ma) AS ca, disp FROM md JOIN ds USING (f)
), fv AS (SELECT *, CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS fav, list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2] AS gap FROM cs
)"""


_IDENT = "CASE WHEN l_quantity > 48 THEN 'z' WHEN l_linenumber % 2 = 0 THEN 'i' || l_orderkey % 499 END"
#: The rows with the keys of their bookmakers instead of names.
_KEYED = _ROWS.replace("l_shipdate, l_tax, l_discount FROM lineitem", f"l_shipdate, l_tax, l_discount, {_IDENT} AS id FROM lineitem").replace("nw AS (SELECT *, oh + st AS kh, oa - st AS ka FROM mr", """pi AS (SELECT DISTINCT f, b, id FROM mr WHERE id IS NOT NULL
), pc AS (SELECT *, count(*) OVER (PARTITION BY f, b) AS ids, count(*) OVER (PARTITION BY f, id) AS nms FROM pi
), pn AS (SELECT f, b, bool_or(ids > 1 OR nms > 1) AS gone, min(id) AS known FROM pc GROUP BY f, b
), nw AS (SELECT mr.* REPLACE (CASE WHEN coalesce(id, known) IS NOT NULL THEN 'id:' || coalesce(id, known) ELSE 'name:' || mr.b END AS b), oh + st AS kh, oa - st AS ka FROM mr LEFT JOIN pn ON pn.f = mr.f AND pn.b = mr.b WHERE NOT coalesce(gone, false)""").replace("'duplicate_company_conflict:' || m || ':' || b", "'duplicate_company_conflict:' || b || ':' || m")


#: What market rows, their index and their series are made of.
_LINES = ["l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate"]


def _market_rows(lines: DataFrame) -> DataFrame:
    """Market rows of three markets from line items: opening prices, and current ones that moved."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    step = (part % 3 - 1) * 0.12 + (supp % 5 - 2) * 0.05
    total = 2 + (supp % 3) * 0.25 + (part % 2) * 0.25
    side = {"opening_home": 1.5 + F.col("l_discount") * 10, "opening_draw": 3 + F.col("l_tax") * 5, "opening_away": 2.2 + F.col("l_quantity") / 20}
    name = F.element_at(F.array(*map(F.lit, ("ouzhi", "yazhi", "daxiao", "ouzhi"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    line = F.when(name == "daxiao", total)
    side |= {"current_home": side["opening_home"] + step, "current_draw": side["opening_draw"], "current_away": side["opening_away"] - step, "opening_line": F.coalesce(line, (part % 4) * -0.25), "current_line": F.coalesce(line, (part % 4) * -0.25 + (part % 5 - 2) * 0.25 + (supp % 3 - 1) * 0.25)}
    side |= {"opening_over": side["opening_home"], "opening_under": side["opening_away"], "current_over": side["current_home"], "current_under": side["current_away"]}
    return lines.select(part.alias("fixture"), F.concat(F.lit(" b"), (F.col("l_orderkey") % 499).cast("string")).alias("source_bookmaker_name"), F.expr(_IDENT).alias("source_bookmaker_id"), name.alias("market"), *_ROW_ORDER, "l_suppkey", "l_shipdate", "l_tax", "l_discount", *(c.alias(n) for n, c in side.items()))


_ROW_ORDER = ["l_linenumber", "l_orderkey", "l_quantity"]


@_query(f"""WITH {_ROWS}, mv AS (SELECT e.f, fav, round(CASE fav WHEN 0 THEN ph - qh ELSE pa - qa END, 12) AS df, round(CASE fav WHEN 0 THEN pa - qa ELSE ph - qh END, 12) AS dopp, round(pd - qd, 12) AS dd, CASE fav WHEN 0 THEN kh - oh ELSE ka - oa END AS od FROM e JOIN fv USING (f) WHERE fav <> 1
), mo AS (SELECT f, round(median(df), 12) AS dp, round(median(od), 12) AS dod, round(avg((df <= -0.015)::INT), 12) AS cool, round(avg((df >= 0.01)::INT), 12) AS strong, round(avg((dd >= 0.0075 OR dopp >= 0.0075)::INT), 12) AS alt FROM mv GROUP BY f
), li AS (SELECT f, count(*) AS nl, median(CASE fav WHEN 0 THEN -kl ELSE kl END) AS fl, median(CASE fav WHEN 0 THEN ol - kl ELSE kl - ol END) AS dl, avg((CASE fav WHEN 0 THEN ol - kl ELSE kl - ol END <= -0.25)::INT) AS ret, avg((CASE fav WHEN 0 THEN ol - kl ELSE kl - ol END <= 0)::INT) AS flat FROM ok JOIN fv USING (f) WHERE m = 'yazhi' AND fav <> 1 GROUP BY f
), tt AS (SELECT f, median(tl) AS tot FROM ok WHERE m = 'daxiao' GROUP BY f
), ir AS (SELECT l_partkey AS f, 'b' || l_orderkey % 499 AS b, (l_linenumber % 5 - 3) * 0.25 AS ln, l_discount + 0.2 AS h, l_tax + 0.2 AS dr, l_quantity / 100 AS a, l_linenumber AS o1, l_orderkey AS o2, l_quantity AS o3 FROM lineitem
), ig AS (SELECT f, b, count(DISTINCT (ln, h, dr, a)) AS v, arg_min((ln::DOUBLE, h, dr, a), (o1, o2, o3)) AS x FROM ir GROUP BY f, b
), ik AS (SELECT ig.f, CASE WHEN x[1] = 0 THEN 'zero' WHEN (fav = 0 AND x[1] >= 0) OR (fav = 2 AND x[1] <= 0) THEN 'wrong' ELSE 'valid' END AS kind, round(1 - 2 * (CASE fav WHEN 0 THEN x[2] ELSE x[4] END) / (x[2] + x[3] + x[4]), 12) AS cv FROM ig JOIN fv USING (f) WHERE v = 1 AND fav <> 1
), ix AS (SELECT f, count(*) FILTER (WHERE kind = 'valid') AS nv, coalesce(avg((cv >= 0.10)::INT) FILTER (WHERE kind = 'valid'), 0) AS conf FROM ik GROUP BY f
), se AS (SELECT f, count(*) AS no, epoch(max(l_shipdate)) - epoch(min(l_shipdate)) AS span, max((ln % 2) * 0.25) - min((ln % 2) * 0.25) AS lr, max(l_tax / 8) - min(l_tax / 8) AS pr FROM mr GROUP BY f
), j AS (SELECT al.f, fav, ch, cd, ca, round(coalesce(gap, 0), 12) AS gap, round(coalesce(disp, 0), 12) AS disp, fav IN (0, 2) AS dir, coalesce(fl, 0) AS fl, coalesce(dl, 0) AS dl, coalesce(dp, 0) AS dp, coalesce(dod, 0) AS dod, round(coalesce(cool, 0), 12) AS cool, round(coalesce(strong, 0), 12) AS strong, round(coalesce(alt, 0), 12) AS alt, round(coalesce(ret, 0), 12) AS ret, round(coalesce(flat, 0), 12) AS flat, tot, coalesce(nv, 0) AS nv, round(coalesce(conf, 0), 12) AS conf, no, span, lr, pr,
  list_sort(list_distinct(coalesce(c, []) || list_filter([CASE WHEN coalesce(n1, 0) < 3 THEN 'insufficient_bookmakers:ouzhi' END, CASE WHEN coalesce(n2, 0) < 3 THEN 'insufficient_bookmakers:yazhi' END, CASE WHEN coalesce(n3, 0) < 3 THEN 'insufficient_bookmakers:daxiao' END, CASE WHEN coalesce(n, 0) < 3 THEN 'insufficient_paired_bookmakers:ouzhi' END, CASE WHEN fav IN (0, 2) AND coalesce(nl, 0) < 3 THEN 'insufficient_paired_bookmakers:yazhi' END], lambda x: x IS NOT NULL))) AS hard
  FROM al LEFT JOIN ct USING (f) LEFT JOIN cf USING (f) LEFT JOIN fv USING (f) LEFT JOIN mo USING (f) LEFT JOIN li USING (f) LEFT JOIN tt USING (f) LEFT JOIN ix USING (f) LEFT JOIN se USING (f)
), y AS (SELECT *, len(hard) > 0 AS bad, coalesce(dir, false) AND abs(fl) IN (0.25, 0.5) AND dp <= -0.015 AND dod >= 0.03 AND cool >= 0.6 AND alt >= 0.6 AS r1, coalesce(dir AND (CASE fav WHEN 0 THEN ch ELSE ca END) >= 0.45 AND gap >= 0.07, false) AS clear FROM j
), z AS (SELECT *, clear AND dl <= -0.25 AND ret >= 0.6 AS r2, clear AND dp >= 0.01 AND strong >= 0.6 AND fl = 0 AND flat >= 0.6 AS r2f, coalesce(tot <= 2.25 AND cd >= 0.28 AND abs(fl) <= 0.5, false) AS r3, nv >= 3 AND conf >= 0.6 AS r4, no >= 3 AND span >= 1800 AND coalesce(lr <= 0.25 AND pr <= 0.015, false) AS r5, disp > 0.035 AS r6 FROM y)
SELECT f AS fixture, CASE WHEN bad OR ((r1 OR r2) AND (r3 OR r4 OR r6)) THEN 'abstain' WHEN r1 OR r2 THEN 'downgrade' WHEN r2f OR r3 OR r4 OR r6 OR r5 THEN 'caution' ELSE 'keep' END AS action, CASE WHEN bad OR ((r1 OR r2) AND (r3 OR r4 OR r6)) THEN 'observation_only' WHEN r1 OR r2 THEN 'low' END AS cap,
  CASE WHEN bad THEN 'r0_data_integrity' ELSE array_to_string(list_filter([CASE WHEN r1 THEN 'r1_shallow_favorite_cooling' END, CASE WHEN r2 THEN 'r2_asian_retreat' END, CASE WHEN r2f THEN 'r2_euro_strong_asian_flat' END, CASE WHEN r3 THEN 'r3_low_total_draw_tail' END, CASE WHEN r4 THEN 'r4_handicap_cover_conflict' END, CASE WHEN r5 THEN 'r5_live_market_stability' END, CASE WHEN r6 THEN 'r6_bookmaker_dispersion' END], lambda v: v IS NOT NULL), ',') END AS flags, array_to_string(hard, ',') AS hard FROM z""")
def first_guardrail_job(spark: SparkSession, d: str) -> DataFrame:
    """Market rows to features to rules, all fixtures at once."""
    l = dealt(_read(spark, d, "lineitem").select(*_LINES), ["l_partkey"])
    index = l.select(F.col("l_partkey").alias("fixture"), F.concat(F.lit("b"), (F.col("l_orderkey") % 499).cast("string")).alias("book"), ((F.col("l_linenumber") % 5 - 3) * 0.25).alias("line"), (F.col("l_discount") + 0.2).alias("home"), (F.col("l_tax") + 0.2).alias("draw"), (F.col("l_quantity") / 100).alias("away"), *_ROW_ORDER)
    series = l.select(F.col("l_partkey").alias("fixture"), F.col("l_shipdate").alias("observed_at"), ((F.col("l_linenumber") % 2) * 0.25).alias("line"), (F.col("l_tax") / 8).alias("probability"))
    g = rules.first_guardrail(pipelines.first_guardrail_features(_market_rows(l), index, series, ["fixture"], _ROW_ORDER))
    return g.select("fixture", F.col("proposed_action").alias("action"), F.col("proposed_confidence_cap").alias("cap"), F.array_join("rule_flags", ",").alias("flags"), F.array_join("hard_reasons", ",").alias("hard"))


def _run_sql() -> str:
    """The SQL of first_guardrail_job over the rows that a prediction could know, with what that adds."""
    body = SQL["first_guardrail_job"].removeprefix(f"WITH {_ROWS}")
    moves, rest = body.split("), ir AS (", 1)
    index, rest = rest.split("\n), ig AS (", 1)[1].split("), se AS (", 1)
    joined, final = rest.split("\n), j AS (", 1)[1].split("\nSELECT f AS fixture", 1)
    joined = joined.replace("SELECT al.f, fav", "SELECT al.f, warnings, row_ids, fav").replace("lambda x: x IS NOT NULL))) AS hard", "lambda x: x IS NOT NULL) || coalesce(reasons, []))) AS hard").replace("LEFT JOIN se USING (f)", "LEFT JOIN se USING (f) LEFT JOIN rs USING (f) LEFT JOIN un USING (f) LEFT JOIN ri USING (f)").replace("no, span,", "coalesce(no, 0) AS no, coalesce(span, 0) AS span,")
    rows = _ROWS[_ROWS.index("nw AS (") :].replace("al AS (SELECT DISTINCT f FROM mr", "al AS (SELECT f FROM fine")
    flags = final[final.index("CASE WHEN bad THEN 'r0_data_integrity'") : final.index(" AS flags")]
    action, cap = final[final.index("CASE WHEN bad OR") : final.index(" AS action")], final[final.index("AS action, ") + 11 : final.index(" AS cap")]
    return f"""WITH pr AS (
  SELECT 'p' || k || '-' || t AS f, k, t, TIMESTAMP '1997-06-01' + to_days((k % 300)::INT) - to_days((1 - t)::INT) AS cutoff FROM (SELECT DISTINCT o_custkey AS k FROM orders), (SELECT unnest([0, 1]) AS t)
), pp AS (SELECT *, cutoff + to_hours(CASE WHEN k % 23 = 0 THEN -1 ELSE (k % 2 * 30)::INT END) AS published FROM pr
), bt AS (SELECT o_orderkey AS o, o_custkey AS k, o_orderkey % 2 AS t, o_orderdate AS core, o_orderdate + to_days((o_orderkey % 3)::INT) AS done FROM orders WHERE o_orderkey % 10 <> 0
), known AS (SELECT f, pp.k, pp.t, cutoff, published, o, core, done FROM pp JOIN bt ON bt.k = pp.k AND bt.t = pp.t AND core <= cutoff AND done <= published
), sel AS (SELECT f, arg_max(o, (core, done, 'b' || o)) AS o FROM known GROUP BY f
), st AS (SELECT pp.*, o, CASE WHEN published < cutoff THEN 'invalid_assessment_time_order' WHEN k % 29 = 0 THEN 'selected_batch_reference_conflict' END AS why FROM pp LEFT JOIN sel USING (f)
), fine AS (SELECT * FROM st WHERE why IS NULL), hist AS (SELECT known.* FROM known JOIN fine USING (f)
), ln AS (
  SELECT l_orderkey AS o, m, 'b' || l_suppkey AS b, l_linenumber AS ln, l_quantity AS qt, l_shipdate, l_tax, l_discount, 1.5 + l_discount * 10 AS oh, 3 + l_tax * 5 AS od, 2.2 + l_quantity / 20 AS oa,
    (l_partkey % 3 - 1) * 0.12 + (l_suppkey % 5 - 2) * 0.05 AS st, (l_partkey % 4) * -0.25 AS ol, (l_partkey % 4) * -0.25 + (l_partkey % 5 - 2) * 0.25 + (l_suppkey % 3 - 1) * 0.25 AS kl, 2 + (l_suppkey % 3) * 0.25 + (l_partkey % 2) * 0.25 AS tl
  FROM lineitem, (SELECT unnest(['ouzhi', 'yazhi', 'daxiao']) AS m) WHERE m <> 'ouzhi' OR l_orderkey % 11 <> 0
), un0 AS (SELECT f, m, b FROM hist JOIN ln USING (o) WHERE l_shipdate <= cutoff GROUP BY f, m, b HAVING count(DISTINCT CASE m WHEN 'ouzhi' THEN (oh, od, oa) WHEN 'yazhi' THEN (oh, ol::DOUBLE, oa) ELSE (oh, tl::DOUBLE, oa) END) > 1
), un AS (SELECT f, array_to_string(list_sort(list('provider_opening_changed:' || m || ':' || b)), ',') AS warnings FROM un0 GROUP BY f
), mr AS (SELECT fine.f, ln.b, ln.ln, ln.o AS ok, qt, ln.m, oh, od, oa, ln.st, ol, kl, tl FROM fine JOIN ln ON ln.o = fine.o AND l_shipdate <= cutoff LEFT JOIN un0 ON un0.f = fine.f AND un0.m = ln.m AND un0.b = ln.b WHERE un0.f IS NULL
), ix0 AS (SELECT fine.f, l_suppkey, l_linenumber, l_discount, l_tax, l_quantity FROM fine JOIN lineitem ON l_orderkey = o AND o % 4 = 0 AND l_shipdate <= cutoff
), ri AS (SELECT f, array_to_string(list_sort(list(DISTINCT r)), ',') AS row_ids FROM (SELECT f, 'r' || ok || '-' || ln || '-' || m AS r FROM mr UNION ALL SELECT ix0.f, 'r' || o || '-' || l_linenumber || '-rangqiu' FROM ix0 JOIN fine USING (f)) GROUP BY f
), sn AS (SELECT f, o, k, t, cutoff, m, m <> 'rangqiu' AS core, CASE WHEN (m = 'ouzhi' AND o % 11 = 0) OR (m = 'rangqiu' AND o % 4 <> 0) THEN false ELSE o IS NOT NULL END AS named, m = 'yazhi' AND o % 13 = 0 AS lost, m = 'daxiao' AND o % 17 = 0 AS moved, o % 7 = 0 AND core_at + INTERVAL 400 DAY > cutoff AS late,
    (SELECT count(*) FROM mr WHERE mr.f = x.f AND mr.m = x.m) AS n
  FROM (SELECT fine.*, core AS core_at, mm.m FROM fine LEFT JOIN bt USING (o), (SELECT unnest(['ouzhi', 'yazhi', 'daxiao', 'rangqiu']) AS m) mm) x
), rs AS (SELECT f, flatten(list(list_filter([CASE WHEN core AND NOT named THEN 'missing_snapshot:' || m END, CASE WHEN core AND named AND lost THEN 'missing_snapshot_record:' || m END, CASE WHEN named AND NOT lost AND (moved OR late) THEN 'snapshot_reference_conflict:' || m END,
    CASE WHEN core AND named AND NOT lost AND (n = 0 OR (m = 'yazhi' AND o % 19 = 0)) THEN 'source_hash_mismatch:' || m END], lambda x: x IS NOT NULL))) AS reasons FROM sn GROUP BY f
), {rows}{moves}), ir AS (
  SELECT f, 'b' || l_suppkey AS b, (l_linenumber % 5 - 3) * 0.25 AS ln, l_discount + 0.2 AS h, l_tax + 0.2 AS dr, l_quantity / 100 AS a, l_linenumber AS o1, 0 AS o2, 0 AS o3 FROM ix0
), ig AS ({index}), hb AS (SELECT hist.f, o, core, done, k || '-' || year(core) AS h, fav FROM hist JOIN fv USING (f) WHERE fav <> 1 AND o % 11 <> 0 AND o % 13 <> 0
), hr AS (SELECT f, o, m, b, count(DISTINCT CASE m WHEN 'ouzhi' THEN (oh + ln.st, od, oa - ln.st) ELSE (kl::DOUBLE, 0::DOUBLE, 0::DOUBLE) END) AS v, any_value(oh + ln.st) AS kh, any_value(od) AS od, any_value(oa - ln.st) AS ka, any_value(kl) AS kl FROM hist JOIN ln USING (o) WHERE m <> 'daxiao' AND l_shipdate <= cutoff GROUP BY f, o, m, b
), hd AS (SELECT f, o, (1/kh)/(1/kh+1/od+1/ka) AS ph, (1/od)/(1/kh+1/od+1/ka) AS pd, (1/ka)/(1/kh+1/od+1/ka) AS pa FROM hr WHERE m = 'ouzhi' AND v = 1
), hm AS (SELECT f, o, median(ph) AS mh, median(pd) AS mdr, median(pa) AS ma FROM hd GROUP BY f, o HAVING count(*) >= 3
), hl AS (SELECT hr.f, hr.o, median(CASE fav WHEN 0 THEN -kl ELSE kl END) AS line FROM hr JOIN hb USING (f, o) WHERE m = 'yazhi' AND v = 1 GROUP BY hr.f, hr.o HAVING count(*) >= 3
), ho AS (SELECT hb.*, line, CASE fav WHEN 0 THEN mh ELSE ma END / (mh + mdr + ma) AS prob, row_number() OVER (PARTITION BY f, h ORDER BY core, done, 'b' || o) AS rn FROM hb JOIN hm USING (f, o) JOIN hl USING (f, o) WHERE NOT EXISTS (SELECT 1 FROM hr WHERE hr.f = hb.f AND hr.o = hb.o AND v > 1)
), se AS (SELECT f, count(*) AS no, epoch(max(core)) - epoch(min(core)) AS span, max(line) - min(line) AS lr, max(prob) - min(prob) AS pr FROM ho WHERE rn = 1 GROUP BY f
), j AS ({joined}, res AS (SELECT f, 'eligible' AS status, {action} AS action, {cap} AS cap, {flags} AS flags, array_to_string(hard, ',') AS hard, coalesce(warnings, '') AS warnings, coalesce(row_ids, '') AS row_ids, no AS observation_count, CAST(span AS BIGINT) AS span_seconds FROM z
  UNION ALL SELECT f, 'unavailable', 'abstain', 'observation_only', why, why, '', '', 0, 0 FROM st WHERE why IS NOT NULL)
SELECT res.f AS prediction, 'b' || o AS batch, res.* EXCLUDE f, sha256('guardrail_assessment|' || res.f || '|v1') AS record_id, CASE WHEN t = 1 THEN sha256('guardrail_assessment|p' || k || '-0|v1') END AS previous_record FROM res JOIN st USING (f)"""


@_query(_run_sql())
def guardrail_run(spark: SparkSession, d: str) -> DataFrame:
    """The first guardrail as of two predictions for each customer: an order is a batch of its customer, a line item a row of each of three markets, and of a fourth in every fourth order."""
    o, l, hours = _read(spark, d, "orders"), _read(spark, d, "lineitem"), F.make_dt_interval
    k, key = F.col("k"), F.col("o_orderkey")
    names, target = ("ouzhi", "yazhi", "daxiao", "rangqiu"), lambda t: F.when(t == 0, "T-24h").otherwise("T-6h")
    snapshot = lambda m: F.concat(F.lit("s"), key, F.lit(m))
    has = {"ouzhi": key % 11 != 0, "rangqiu": key % 4 == 0}
    results = F.create_map(*(x for m in names for x in (F.lit(m), F.struct(F.when(has.get(m, F.lit(True)), snapshot(m)).alias("snapshot_record_id")))))
    batches = o.select(F.concat(F.lit("b"), key).alias("record_id"), F.col("o_custkey").alias("fixture_id"), target(key % 2).alias("target"), F.col("o_orderdate").cast("timestamp").alias("core_observed_at"), (F.col("o_orderdate") + hours((key % 3).cast("int"))).cast("timestamp").alias("completed_at"), (key % 10 != 0).alias("model_strict_eligible"), results.alias("market_results"))
    each = o.select("*", F.explode(F.array(*map(F.lit, names))).alias("m"))
    sha = F.concat(F.lit("h"), "o_custkey", F.lit("-"), F.year("o_orderdate"), F.col("m"))
    seen = (F.col("o_orderdate") + hours(F.when(key % 7 == 0, 400).otherwise(0))).cast("timestamp")
    moved = F.when((F.col("m") == "daxiao") & (key % 17 == 0), "T-10m").otherwise(target(key % 2))
    snapshots = each.where("NOT (m = 'yazhi' AND o_orderkey % 13 = 0)").select(F.concat(F.lit("s"), key, F.col("m")).alias("record_id"), F.col("o_custkey").alias("fixture_id"), F.col("m").alias("market"), moved.alias("target"), seen.alias("observed_at"), sha.alias("raw_sha256"))
    lines = _market_rows(l).drop("market", "source_bookmaker_name").withColumn("m", F.explode(F.array(*map(F.lit, names)))).join(each.select(key.alias("l_orderkey"), "m", sha.alias("sha")), ["l_orderkey", "m"])
    name = F.concat(F.lit(" b"), "l_suppkey").alias("source_bookmaker_name")
    page = F.when((F.col("m") == "yazhi") & (F.col("l_orderkey") % 19 == 0), "x").otherwise(F.col("sha"))
    common = [F.concat(F.lit("r"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "m").alias("record_id"), F.concat(F.lit("s"), "l_orderkey", "m").alias("source_snapshot_record_id"), name, F.col("l_linenumber").alias("source_row_index"), page.alias("source_page_sha256"), F.col("l_shipdate").cast("timestamp").alias("observed_at")]
    part, supp = F.col("fixture"), F.col("l_suppkey")  # of a market row the fixture is the part
    total, moved_line = 2 + (supp % 3) * 0.25 + (part % 2) * 0.25, (part % 5 - 2) * 0.25 + (supp % 3 - 1) * 0.25
    lines = lines.withColumns({"opening_line": F.when(F.col("m") == "daxiao", total).otherwise((part % 4) * -0.25), "current_line": F.when(F.col("m") == "daxiao", total).otherwise((part % 4) * -0.25 + moved_line)})
    rows = lines.where("m != 'rangqiu'").select(F.col("m").alias("market"), *common, F.col("sha").alias("source_workbook_sha256"), *(f"{s}_{f}" for s in ("opening", "current") for f in ("home", "draw", "away", "line", "over", "under")))
    index = lines.where("m = 'rangqiu'").select(*common, ((F.col("l_linenumber") % 5 - 3) * 0.25).alias("line"), (F.col("l_discount") + 0.2).alias("home"), (F.col("l_tax") + 0.2).alias("draw"), (F.col("l_quantity") / 100).alias("away"))
    both = o.select(F.col("o_custkey").alias("k")).distinct().withColumn("t", F.explode(F.array(F.lit(0), F.lit(1))))
    cutoff = F.lit("1997-06-01").cast("timestamp") + hours((k % 300).cast("int")) - hours(1 - F.col("t"))
    p = both.select(F.concat(F.lit("p"), k, F.lit("-"), F.col("t")).alias("prediction"), k.alias("fixture_id"), target(F.col("t")).alias("target"), cutoff.alias("prediction_cutoff"), (cutoff + hours(F.lit(0), F.when(k % 23 == 0, -1).otherwise((k % 2 * 30).cast("int")))).alias("published_at"))
    last = guardrails.batch_history(p, batches).groupBy("prediction").agg(F.max_by("batch_record_id", F.struct("core_observed_at", "completed_at", "batch_record_id")).alias("last"))
    own = p.join(last, "prediction", "left").withColumn("selected_batch_record_id", F.when(F.col("fixture_id") % 29 == 0, "other").otherwise(F.col("last"))).drop("last")
    got = guardrails.first_guardrail_run(own, batches, snapshots, rows, index, F.lit("1999-01-01").cast("timestamp"), "v1")
    text = lambda c: F.array_join(c, ",")
    return got.select("prediction", F.col("batch_record_id").alias("batch"), F.col("audit_status").alias("status"), F.col("proposed_action").alias("action"), F.col("proposed_confidence_cap").alias("cap"), text("rule_flags").alias("flags"), text("hard_reasons").alias("hard"), text("opening_warnings").alias("warnings"), text("source_row_record_ids").alias("row_ids"), "observation_count", "span_seconds", "record_id", "previous_record")


@_query(f"""WITH {_KEYED}, ev AS (SELECT * FROM e WHERE kh > 1 AND ka > 1), mf AS (SELECT f, count(*) AS n, median(ph) AS mh, median(pd) AS mdr, median(pa) AS ma FROM ev GROUP BY f
), dz AS (SELECT ev.f, greatest(median(abs(ph - mh)), median(abs(pd - mdr)), median(abs(pa - ma))) AS disp FROM ev JOIN mf USING (f) GROUP BY ev.f
), gd AS (SELECT f, n, mh / (mh + mdr + ma) AS ch, mdr / (mh + mdr + ma) AS cd, ma / (mh + mdr + ma) AS ca, disp FROM mf JOIN dz USING (f)
), bd AS (SELECT *, CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS fav, list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2] AS gap FROM gd
), dv AS (SELECT ev.*, fav, ph - ch AS eh, pd - cd AS ed, pa - ca AS ea, count(*) OVER (PARTITION BY f) AS nn FROM ev JOIN bd USING (f)
), dm AS (SELECT *, median(abs(eh)) OVER (PARTITION BY f) AS m0, median(abs(ed)) OVER (PARTITION BY f) AS m1, median(abs(ea)) OVER (PARTITION BY f) AS m2, greatest(abs(eh), abs(ed), abs(ea)) AS most FROM dv
), an AS (SELECT *, nn >= 5 AND most >= 0.03 AND (coalesce(abs(CASE WHEN m0 > 0 THEN 0.6745 * eh / m0 END) >= 3.5, false) OR coalesce(abs(CASE WHEN m1 > 0 THEN 0.6745 * ed / m1 END) >= 3.5, false) OR coalesce(abs(CASE WHEN m2 > 0 THEN 0.6745 * ea / m2 END) >= 3.5, false) OR (m0 = 0 AND abs(eh) >= 0.03) OR (m1 = 0 AND abs(ed) >= 0.03) OR (m2 = 0 AND abs(ea) >= 0.03)) AS odd, round(CASE fav WHEN 0 THEN ph - qh WHEN 1 THEN pd - qd ELSE pa - qa END, 12) AS dl FROM dm
), ay AS (SELECT f, b, ol, kl, oh, oa, kh, ka FROM ok WHERE m = 'yazhi'), ty AS (SELECT f, b FROM ok WHERE m = 'daxiao'
), sg AS (SELECT an.f, an.b, odd, dl, fav, ay.b IS NOT NULL AS has, CASE fav WHEN 0 THEN ol - kl ELSE kl - ol END AS mvl, CASE fav WHEN 0 THEN round((1/(1+ay.kh))/(1/(1+ay.kh)+1/(1+ay.ka)) - (1/(1+ay.oh))/(1/(1+ay.oh)+1/(1+ay.oa)), 12) ELSE round((1/(1+ay.ka))/(1/(1+ay.kh)+1/(1+ay.ka)) - (1/(1+ay.oa))/(1/(1+ay.oh)+1/(1+ay.oa)), 12) END AS pm, ty.b IS NOT NULL AS hast FROM an LEFT JOIN ay ON ay.f = an.f AND ay.b = an.b LEFT JOIN ty ON ty.f = an.f AND ty.b = an.b
), sn AS (SELECT *, CASE WHEN dl >= 0.015 THEN 'support' WHEN dl <= -0.015 THEN 'oppose' ELSE 'unchanged' END AS euro, CASE WHEN NOT has OR fav = 1 THEN 'not_evaluable' WHEN mvl >= 0.25 OR (abs(mvl) < 1e-12 AND pm >= 0.015) THEN 'confirm' WHEN mvl <= -0.25 OR (abs(mvl) < 1e-12 AND pm <= -0.015) THEN 'conflict' ELSE 'flat' END AS asian FROM sg
), sr AS (SELECT f, b, count(*) AS sn, epoch(max(l_shipdate)) - epoch(min(l_shipdate)) AS span, max(l_tax / 8) - min(l_tax / 8) AS rng, min(abs(l_discount - 0.05)) AS least, count(*) FILTER (WHERE l_discount - 0.05 > 0) AS up FROM nw GROUP BY 1, 2
), st AS (SELECT sn.f AS fx, sn.b, euro, asian, odd, (euro = 'support' AND asian = 'conflict') OR (euro = 'oppose' AND asian = 'confirm') AS inn, sr.sn AS seen, span, coalesce(sr.sn >= 3 AND span >= 1800 AND rng <= 0.0025, false) AS unch, coalesce(sr.sn >= 3 AND span >= 1800 AND least >= 0.03 AND up IN (0, sr.sn), false) AS dis, hast FROM sn LEFT JOIN sr ON sr.f = sn.f AND sr.b = sn.b
), ag AS (SELECT fx AS f, count(*) AS paired, avg((euro = 'support')::INT) AS sup, avg((asian = 'confirm')::INT) FILTER (WHERE asian <> 'not_evaluable') AS con, avg((asian = 'conflict')::INT) FILTER (WHERE asian <> 'not_evaluable') AS cfl, max(seen) AS no, max(span) AS span, count(*) FILTER (WHERE odd) AS iso, count(*) FILTER (WHERE inn) AS inn, count(*) FILTER (WHERE unch) AS unch, count(*) FILTER (WHERE dis) AS dis, count(*) FILTER (WHERE hast) AS nt FROM st GROUP BY fx
), lr AS (SELECT a.f, a.b, median(c.ph) AS h, median(c.pd) AS d, median(c.pa) AS w FROM ev a JOIN ev c ON a.f = c.f AND a.b <> c.b GROUP BY a.f, a.b
), lo AS (SELECT lr.f, max(greatest(abs(h / (h + d + w) - ch), abs(d / (h + d + w) - cd), abs(w / (h + d + w) - ca))) AS shift, bool_or((CASE WHEN h >= d AND h >= w THEN 0 WHEN d >= w THEN 1 ELSE 2 END) <> fav) AS flip FROM lr JOIN bd USING (f) GROUP BY lr.f
), wn AS (SELECT f, list_sort(list(DISTINCT w)) AS warns FROM (SELECT f, 'bookmaker_name_maps_multiple_ids:' || b AS w FROM pc WHERE ids > 1 UNION ALL SELECT f, 'bookmaker_id_maps_multiple_names:' || id FROM pc WHERE nms > 1 UNION ALL SELECT f, unnest(c) FROM cf) GROUP BY f
), j AS (SELECT warns, al.f, coalesce(n1, 0) < 3 OR coalesce(n2, 0) < 3 OR coalesce(n3, 0) < 3 OR coalesce(paired, 0) < 3 OR bd.ch IS NULL AS bad, fav = 1 AS dr, coalesce(paired, 0) < 5 AS few, round(gap, 12) < 0.07 AS weak, round(coalesce(sup, 0), 12) >= 0.6 AS sup, round(coalesce(con, 0), 12) >= 0.6 AS con, round(coalesce(cfl, 0), 12) >= 0.6 AS cfl, round(disp, 12) > 0.035 AS wide, coalesce(no, 0) >= 3 AND coalesce(span, 0) >= 1800 AS ready, iso, dis, inn, unch, coalesce(flip, false) AS flip, round(coalesce(shift, 0), 12) >= 0.03 AS shift
  FROM al LEFT JOIN ct USING (f) LEFT JOIN bd USING (f) LEFT JOIN ag USING (f) LEFT JOIN lo USING (f) LEFT JOIN wn USING (f)
), y AS (SELECT *, (cfl OR inn > 0)::INT + wide::INT + (iso > 0)::INT + (flip OR shift)::INT AS main, weak OR few OR NOT ready OR dis > 0 OR unch > 0 OR dr OR warns IS NOT NULL AS aux FROM j)
SELECT f AS fixture, CASE WHEN bad OR (flip AND few) OR main >= 2 THEN 'abstain' WHEN main = 1 THEN 'downgrade' WHEN aux OR NOT sup OR (NOT dr AND NOT con) THEN 'caution' ELSE 'keep' END AS action, CASE WHEN bad OR (flip AND few) OR main >= 2 THEN 'observation_only' WHEN main = 1 THEN 'low' WHEN NOT few AND NOT weak AND NOT wide THEN 'medium' ELSE 'low' END AS cap, coalesce(array_to_string(warns, ','), '') AS warnings FROM y""")
def second_guardrail_job(spark: SparkSession, d: str) -> DataFrame:
    """Institutions across three markets, paired by their keys, with their signals, anomalies and series, to rules. Some ids have several names and some names several ids."""
    rows = _market_rows(dealt(_read(spark, d, "lineitem").select(*_LINES), ["l_partkey"]))
    series = market.bookmaker_keys(rows, ["fixture"], "source_bookmaker_name", "source_bookmaker_id")[0].select("fixture", F.col("bookmaker_key").alias("book"), F.col("l_shipdate").alias("observed_at"), F.struct("l_linenumber", "l_orderkey").alias("record_id"), (F.col("l_tax") / 8).alias("probability"), (F.col("l_discount") - 0.05).alias("deviation"))
    g = rules.second_guardrail(pipelines.second_guardrail_features(rows, series, ["fixture"], _ROW_ORDER))
    return g.select("fixture", F.col("proposed_action").alias("action"), F.col("proposed_confidence_cap").alias("cap"), F.array_join("pairing_warnings", ",").alias("warnings"))


@_query(f"""WITH {_SCORED}, a AS (SELECT *, ['T-24h', 'T-6h', 'T-10m'][(fixture % 3 + 1)::INT] AS target, CASE WHEN fixture % 4 > 0 THEN 'full_update' END AS upd, CASE fixture % 2 WHEN 0 THEN 'keep' ELSE 'caution' END AS act, CASE WHEN fixture % 5 > 0 THEN 'provisional' END AS mat, CASE WHEN fixture % 6 = 0 THEN 'matched' ELSE 'not_matched' END AS r1 FROM sc
), x AS (SELECT 'by_target' AS dimension, target AS value, hit, log_loss FROM a UNION ALL SELECT 'by_market_update_status', coalesce(upd, 'legacy_analysis_flow'), hit, log_loss FROM a UNION ALL SELECT 'by_action', act, hit, log_loss FROM a UNION ALL SELECT 'by_sample_maturity', coalesce(mat, 'legacy_analysis_flow'), hit, log_loss FROM a UNION ALL SELECT 'by_rule', 'r1|' || r1, hit, log_loss FROM a UNION ALL SELECT 'overall', 'all', hit, log_loss FROM a)
SELECT dimension, value, count(*) AS n, round(avg(hit), 8) AS accuracy, round(avg(log_loss), 8) AS log_loss FROM x GROUP BY 1, 2""")
def forward_evaluation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("fixture")
    a = _scored(spark, d).withColumns({
        "target": F.element_at(F.array(*map(F.lit, ("T-24h", "T-6h", "T-10m"))), (k % 3 + 1).cast("int")), "market_update_status": F.when(k % 4 > 0, "full_update"), "proposed_action": F.when(k % 2 == 0, "keep").otherwise("caution"),
        "sample_maturity": F.when(k % 5 > 0, "provisional"), "rule_evaluations": F.create_map(F.lit("r1"), rules.state(k % 6 == 0)),
    })
    return reports.forward_metrics(a, [F.count("*").alias("n"), F.round(F.avg("hit"), 8).alias("accuracy"), F.round(F.avg("log_loss"), 8).alias("log_loss")])


@_query(f"""WITH {_SCORED}, p AS (SELECT fixture, competition, CASE WHEN fixture % 5 = 0 THEN 'abstained' ELSE 'published' END AS status, log_loss, hit, fixture % 3 <> 0 AS done FROM sc), x AS (SELECT 'competition' AS dimension, CASE WHEN fixture % 7 = 0 THEN 'legacy_unclassified' ELSE competition END AS value, * EXCLUDE competition FROM p UNION ALL SELECT 'overall', 'all', * EXCLUDE competition FROM p)
SELECT dimension, value, count(*) AS predictions, count(*) FILTER (WHERE status = 'published') AS published, count(*) FILTER (WHERE status = 'published' AND NOT done) AS awaiting_result, count(*) FILTER (WHERE status = 'published' AND done) AS sample_size, round(avg(log_loss) FILTER (WHERE status = 'published' AND done), 8) AS log_loss, round(avg(hit) FILTER (WHERE status = 'published' AND done), 8) AS accuracy FROM x GROUP BY 1, 2""")
def shadow_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Predictions without a result stay in the counts."""
    fx = _fixtures(spark, d)
    p = _agreed(spark, d).select(F.col("fixture").alias("fixture_id"), "p").join(fx.select(F.col("fixture").alias("fixture_id"), "competition"), "fixture_id").withColumns({"status": F.when(F.col("fixture_id") % 5 == 0, "abstained").otherwise("published"), "competition": F.when(F.col("fixture_id") % 7 != 0, F.col("competition"))})
    results = fx.where("fixture % 3 != 0").select(F.col("fixture").alias("fixture_id"), F.when(F.col("actual") == 0, 1).otherwise(0).alias("home_goals"), F.when(F.col("actual") == 2, 1).otherwise(0).alias("away_goals"))
    e = pipelines.evaluate_shadow(p, results, {"competition": F.col("competition")})
    return e.select("dimension", "value", "predictions", "published", "awaiting_result", "sample_size", _r("log_loss"), _r("accuracy"))


@_query("""WITH p AS (SELECT event_id AS k, ['keep', 'caution', 'downgrade', 'abstain'][(event_id % 4 + 1)::INT] AS act, value / 100 AS h, user_id % 3 AS c FROM events) SELECT k AS event_id, CASE WHEN act <> 'abstain' THEN CASE WHEN h >= 0.5 THEN 'home' ELSE 'away' END END AS direction, CASE WHEN act = 'abstain' THEN 'observation_only' WHEN act = 'downgrade' AND c > 0 THEN 'low' ELSE ['low', 'medium', 'high'][(c + 1)::INT] END AS confidence,
  CASE WHEN k % 5 = 0 THEN 'not_available' WHEN k % 2 = 0 AND k % 3 = 0 THEN 'unchanged' WHEN k % 2 <> 0 AND k % 3 <> 0 THEN 'full_update' ELSE 'partial_update' END AS market_update FROM p""")
def presented_predictions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    pick = lambda of, names: F.element_at(F.array(*map(F.lit, names)), (of + 1).cast("int"))
    e = _read(spark, d, "events").select("event_id", pick(k % 4, ("keep", "caution", "downgrade", "abstain")).alias("act"), F.array(F.col("value") / 100, F.lit(-1.0), 1 - F.col("value") / 100).alias("p"), pick(F.col("user_id") % 3, ("low", "medium", "high")).alias("conf"), F.when(k % 5 != 0, F.lit("a")).alias("e1"), F.lit("a").alias("a1"), F.when(k % 2 == 0, "a").otherwise("b").alias("e0"), F.when(k % 3 == 0, "a").otherwise("b").alias("a0"))
    shown = odds.presented("act", "p", "conf")
    return e.select("event_id", shown["direction"].alias("direction"), shown["confidence"].alias("confidence"), ids.update_class(["e1", "a1"], ["e0", "a0"])["status"].alias("market_update"))


@_query("""WITH o AS (SELECT l_orderkey AS k, l_linenumber, round(1 + l_discount, 2) AS a, round(1 + l_tax, 2) AS b, l_linestatus AS old FROM lineitem), x AS (SELECT k, a, b, count(*) FILTER (WHERE old = 'F') AS n, count(*) FILTER (WHERE old = 'O' OR l_linenumber = 1) AS m FROM o GROUP BY k, a, b) SELECT k AS snapshot, bool_and(m >= n) AS ok FROM x WHERE n > 0 GROUP BY k""")
def price_parity(spark: SparkSession, d: str) -> DataFrame:
    """Whether the rows of a later normalisation keep all prices of the former ones, as often, whatever the names."""
    l = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("snapshot"), "l_linenumber", "l_linestatus", *(F.round(1 + F.col(c), 2).alias(n) for n, c in zip(pipelines.SIGNATURE, ("l_discount", "l_tax", "l_discount", "l_tax"), strict=True)))
    return market.parity(l.where("l_linestatus = 'F'"), l.where("l_linestatus = 'O' OR l_linenumber = 1"), "snapshot", list(pipelines.SIGNATURE))


@_query(f"""WITH {_Q}, s AS (SELECT fixture, book % 10 AS book, line, part, round((line % 5 - 2) * 0.25, 2) AS ln, home FROM q), g AS (SELECT fixture, book, count(DISTINCT ln) AS v, min_by(home, (line, part, home)) AS home FROM s GROUP BY 1, 2) SELECT fixture, count(*) FILTER (WHERE v = 1) AS kept, count(*) FILTER (WHERE v > 1) AS contradictions, round(coalesce(sum(home) FILTER (WHERE v = 1), 0), 6) AS home FROM g GROUP BY fixture""")
def single_rows(spark: SparkSession, d: str) -> DataFrame:
    """Each bookmaker once, and the ones that contradict themselves."""
    q = _quotes(spark, d).select("fixture", (F.col("book") % 10).alias("book"), "line", "part", F.round((F.col("line") % 5 - 2) * 0.25, 2).alias("ln"), "home")
    kept, bad = market.one_row(q, ["fixture"], "book", ["ln"], ["line", "part", "home"])
    n = lambda df, *a: df.groupBy("fixture").agg(*a)
    j = q.select("fixture").distinct().join(n(kept, F.count("*").alias("kept"), F.sum("home").alias("home")), "fixture", "left").join(n(bad, F.count("*").alias("contradictions")), "fixture", "left").na.fill(0)
    return j.select("fixture", "kept", "contradictions", F.round("home", 6).alias("home"))
