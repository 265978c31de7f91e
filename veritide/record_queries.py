"""Registered queries of records, typed views and whole jobs, and the SQL that gives the same rows. Bindings as in job_queries.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from veritide.job_queries import _PART, _market_rows, _written
from veritide.operators import contracts, evidence, score
from veritide.operators.staged import folder, staged
from veritide.plans import pipelines
from veritide.queries import _fixtures, _query, _read
from veritide.sources import facts
from veritide.sources import odds as odds_files
from veritide.streaming import states


def _text(c: str):
    return F.col(c).cast("string")


# --- typed records and current views ---------------------------------------------------------------------------------


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Records of five types, written as a log and imported: orders as normalisations and assessments, line items as market rows, customers as results and exclusions."""
    o, l, c = _read(spark, d, "orders"), _read(spark, d, "lineitem"), _read(spark, d, "customer")
    key, cust = F.col("o_orderkey"), F.col("c_custkey")
    at = lambda col: F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = lambda rid, kind, fixture: [rid.alias("record_id"), F.lit(kind).alias("record_type"), F.lit(1).alias("schema_version"), fixture.cast("string").alias("fixture_id")]
    price = F.struct(F.lit("x").alias("raw"), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5")).alias("decimal"))
    parts = [
        (o, key, [*head(F.concat(F.lit("n"), key), "MarketNormalization", F.col("o_custkey")), F.concat(F.lit("s"), "o_custkey").alias("snapshot_record_id"), (key % 3 + 1).alias("normalization_version"), at("o_orderdate").alias("normalized_at"), F.when(key % 4 != 0, "accepted").otherwise("rejected").alias("status")]),
        (o, key, [*head(F.concat(F.lit("a"), key), "SnapshotEligibilityAssessment", F.col("o_custkey")), F.when(key % 2 == 0, "T-24h").otherwise("T-6h").alias("target"), (key % 10 != 0).alias("model_strict_eligible")]),
        (l, F.col("l_orderkey"), [*head(F.concat(F.lit("r"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), "BookmakerMarketRow", F.lit("-")), F.concat(F.lit("n"), "l_orderkey").alias("normalization_record_id"), F.struct(price.alias("home")).alias("current")]),
        (c, cust, [*head(F.concat(F.lit("v"), cust), "VerifiedResult", cust), F.lit("1998-01-01T00:00:00Z").alias("confirmed_at"), F.lit(1).alias("home_goals"), F.lit("accepted").alias("verification_status")]),
        (c.where("c_custkey % 5 < 2"), cust, [*head(F.concat(F.lit("w"), cust), "VerifiedResult", cust), F.lit("1997-01-01T00:00:00Z").alias("confirmed_at"), F.lit(2).alias("home_goals"), F.when(cust % 5 == 0, "accepted").otherwise("rejected").alias("verification_status"), F.concat(F.lit("v"), cust).alias("supersedes_record_id")]),
        (c.where("c_custkey % 7 = 0"), cust, [*head(F.concat(F.lit("e"), cust), "QualityEvent", cust), F.lit("fixture_excluded").alias("event_type")]),
    ]
    rows = None
    for df, n, cols in parts:
        own = df.select(F.to_json(F.struct(*cols)).alias("value"), (n % 8).alias("part"), F.floor(n / 20_000).alias("chunk"), n.alias("event_id"))
        rows = own if rows is None else rows.unionByName(own)
    new = pipelines.import_facts(spark, _written(rows, sealed=True))["new"]
    return staged(new.select("record_id", "record_type", "raw"))  # what every view reads


_GONE = "(SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0)"
_VERIFIED = f"""vr AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'w' ELSE 'v' END || c_custkey AS record_id, CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS goals FROM customer WHERE c_custkey NOT IN {_GONE})"""


@_query(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 DESC, o_orderdate DESC, 'n' || o_orderkey DESC) AS rn FROM orders WHERE o_orderkey % 4 <> 0), {_VERIFIED}
SELECT 'normalization' AS view, 'n' || o_orderkey AS record_id, 's' || o_custkey AS of, CAST(o_orderkey % 3 + 1 AS DOUBLE) AS value FROM n WHERE rn = 1
UNION ALL SELECT 'row', 'r' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'n' || l_orderkey, CAST(CAST(l_quantity AS INTEGER) || '.5' AS DOUBLE) FROM lineitem JOIN n ON o_orderkey = l_orderkey AND rn = 1
UNION ALL SELECT 'verified', record_id, k::VARCHAR, goals::DOUBLE FROM vr UNION ALL SELECT 'invalidated', NULL, c_custkey::VARCHAR, NULL FROM customer WHERE c_custkey IN {_GONE}""")
def current_views(spark: SparkSession, d: str) -> DataFrame:
    """A log of typed records, imported: current normalisations and their rows, current results, excluded fixtures. Rows have a fixture of their own, so no exclusion meets them."""
    v = pipelines.current_views(_records(spark, d))
    none = F.lit(None)
    view = lambda name, df, rid, of, value: df.select(F.lit(name).alias("view"), rid.cast("string").alias("record_id"), of.alias("of"), value.cast("double").alias("value"))
    return (
        view("normalization", v["normalizations"], F.col("record_id"), F.col("snapshot_record_id"), F.col("normalization_version"))
        .unionByName(view("row", v["rows"], F.col("record_id"), F.col("normalization_record_id"), F.col("current_home")))
        .unionByName(view("verified", v["verified"], F.col("record_id"), F.col("fixture_id"), F.col("home_goals")))
        .unionByName(view("invalidated", v["invalidated"], none, F.col("fixture_id"), none))
    )


@_query(f"""WITH {_VERIFIED} SELECT DISTINCT k::VARCHAR AS fixture_id, CASE WHEN o_orderkey % 2 = 0 THEN 'T-24h' ELSE 'T-6h' END AS target, goals AS home_goals FROM orders JOIN vr ON k = o_custkey WHERE o_orderkey % 10 <> 0""")
def strict_results(spark: SparkSession, d: str) -> DataFrame:
    """Fixtures that have an eligible batch at a target and a current result."""
    records = _records(spark, d)
    verified = pipelines.current_views(records)["verified"]
    return pipelines.strict_results(facts.typed(records, "SnapshotEligibilityAssessment").drop("record_id"), verified.select("fixture_id", "home_goals", "away_goals")).select("fixture_id", "target", "home_goals")


@_query("""WITH r AS (SELECT l_suppkey % 20 AS f, l_shipdate AS seen, CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate + to_days(l_suppkey::INT) END AS fixed, 'r' || l_orderkey || '-' || l_linenumber AS record_id, l_returnflag AS market FROM lineitem)
, x AS (SELECT record_id, market, seen, row_number() OVER (ORDER BY seen, market, record_id) AS place FROM r WHERE f = 7 AND seen <= TIMESTAMP '1996-06-01' AND (fixed IS NULL OR fixed <= TIMESTAMP '1996-06-01'))
SELECT via, record_id, market FROM x, (VALUES ('frame', 10000), ('statement', 9000000)) v(via, most) WHERE place <= most""")
def rows_by_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a fixture that were known by a cutoff, up to the 10,000 that the operator gives at most, and all of them by a parameterised statement."""
    l = _read(spark, d, "lineitem")
    fixed = F.when(F.col("l_linenumber") % 3 == 0, F.col("l_shipdate") + F.make_dt_interval(F.col("l_suppkey").cast("int")))
    rows = l.select((F.col("l_suppkey") % 20).cast("string").alias("fixture_id"), F.concat(F.lit("r"), "l_orderkey", F.lit("-"), "l_linenumber").alias("record_id"), F.col("l_returnflag").alias("market"), F.col("l_shipdate").cast("timestamp").alias("observed_at"), fixed.cast("timestamp").alias("corrected_at"))
    cutoff = "1996-06-01 00:00:00"
    frame = pipelines.market_rows_as_of(rows, "7", F.lit(cutoff).cast("timestamp"), 10_000)
    statement = spark.sql(pipelines.AS_OF_SQL.replace("market_rows", "{market_rows}").replace(":cutoff", f"TIMESTAMP '{cutoff}'").replace(":fixture", "'7'"), market_rows=rows)
    return frame.select(F.lit("frame").alias("via"), "record_id", "market").unionByName(statement.select(F.lit("statement").alias("via"), "record_id", "market"))


# --- research import, training, re-normalisation -----------------------------------------------------------------------


@_query("""WITH c AS (SELECT c_custkey AS k, c_nationkey AS p, c_nationkey = 3 AND c_custkey % 2 = 0 AS bad FROM customer), f AS (SELECT p, CASE WHEN p % 5 = 0 THEN 'existing' WHEN p % 7 = 0 THEN 'changed' ELSE 'new' END AS status, bool_or(bad) AS bad FROM c GROUP BY p)
SELECT 'file' AS what, p AS part, NULL AS record_id, status FROM f UNION ALL SELECT CASE WHEN f.bad THEN 'rejected' ELSE 'new' END, p, 'c' || k, NULL FROM c JOIN f USING (p) WHERE status = 'new'""")
def research_import(spark: SparkSession, d: str) -> DataFrame:
    """A log of one file for each nation: some files are stored already, some were changed since, and one has records whose flags don't fit their kind."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    body = F.to_json(F.struct(F.concat(F.lit("c"), k).alias("record_id"), F.lit("ResearchShadowPrediction").alias("record_type"), F.lit(1).alias("schema_version"), F.lit("shadow_event").alias("research_kind"), F.lit(True).alias("research_only"), ((n == 3) & (k % 2 == 0)).alias("backfill"), F.lit(False).alias("strict_backtest_eligible"), F.lit(False).alias("cutoff_eligible")))
    path = _written(_read(spark, d, "customer").select(body.alias("value"), n.alias("part"), F.lit(0).alias("chunk"), k.alias("event_id")))
    part = F.expr(_PART[0].rsplit(" AS ", 1)[0])
    held = facts.blobs(spark, path).withColumn("file", F.regexp_replace("path", "^file:/+", "file:///")).withColumn("p", part)
    stored = held.where("p % 5 = 0 OR p % 7 = 0").select("file", F.when(F.col("p") % 5 == 0, F.col("sha256")).otherwise("other").alias("sha256"))
    got = pipelines.import_research(spark, path, stored)
    row = lambda what, df, rid, status: df.select(F.lit(what).alias("what"), part.alias("part"), rid.alias("record_id"), status.alias("status"))
    none = F.lit(None).cast("string")
    return row("file", got["files"], none, F.col("status")).unionByName(row("new", got["new"], F.col("record_id"), none)).unionByName(row("rejected", got["rejected"], F.col("record_id"), none))


@_query("""WITH p AS (SELECT o_orderkey AS k, o_orderdate AS day, o_orderkey % 3 AS actual, 1 + o_orderkey % 4 AS a, 1 + o_custkey % 3 AS b FROM orders), t AS (SELECT *, k || '|' || strftime(day, '%Y-%m-%d') || '|' || actual || '|' || (a / 8) || ',' || (b / 8) || ',' || ((8 - a - b) / 8) AS m FROM p
), h AS (SELECT sha256(m) AS m FROM t), g AS (SELECT substr(m, 1, 3) AS bucket, sha256(string_agg(m, chr(10) ORDER BY m)) AS h FROM h GROUP BY 1), d AS (SELECT sha256(string_agg(h, chr(10) ORDER BY bucket)) AS dh FROM g
), v AS (SELECT dh, 'base-' || substr(dh, 1, 12) || '-20260101T000000Z' AS mv FROM d), r AS (SELECT *, sha256('research_model_version|base|' || mv) AS rid FROM v)
SELECT dh AS dataset_hash, mv AS model_version, rid AS record_id, sha256('research_model_activation|shadow|' || rid || '|2026-01-01 00:00:00') AS activation_id, (SELECT count(*) FROM p WHERE day < DATE '1996-01-01') AS train, (SELECT count(*) FROM p WHERE day >= DATE '1996-01-01') AS evaluation FROM r""")
def trained_model(spark: SparkSession, d: str) -> DataFrame:
    """A model version and its activation: both are named by the hash of all points."""
    k, a, b = F.col("o_orderkey"), 1 + F.col("o_orderkey") % 4, 1 + F.col("o_custkey") % 3
    points = _read(spark, d, "orders").select(k.alias("fixture_record_id"), F.col("o_orderdate").cast("date").alias("match_date"), (k % 3).alias("actual"), F.array(a / 8, b / 8, (8 - a - b) / 8).alias("p"))
    got = pipelines.train_model(points, "1996-01-01", "base", F.lit("2026-01-01").cast("timestamp"), "shadow")
    n = lambda part: got[part].agg(F.count("*").alias(part))
    j = got["version"].join(got["activation"].select("model_key", F.col("record_id").alias("activation_id")), "model_key")
    return j.crossJoin(n("train")).crossJoin(n("evaluation")).select("dataset_hash", "model_version", "record_id", "activation_id", "train", "evaluation")  # one row each


_WINDOW = "o_orderdate >= DATE '1994-01-01' AND o_orderdate < DATE '1996-01-01'"


@_query(f"""WITH ex AS (SELECT o_orderkey AS k, {_WINDOW} AS inside, o_orderkey % 3 <> 0 AS held, o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1) AS lost FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
), cu AS (SELECT k, CASE WHEN inside AND NOT lost THEN 2 ELSE 1 END AS version FROM ex WHERE held OR (inside AND NOT lost)
), t AS (SELECT 'b' || o_custkey || '-' || year(o_orderdate) AS b, o_custkey AS c, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, list(o_orderkey) AS ks, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS k1 FROM orders JOIN ex ON k = o_orderkey WHERE inside GROUP BY 1, 2
), u AS (SELECT b, c % 4 <> 0 OR first_at = last_at AS strict, CASE WHEN first_at = last_at AND c % 4 = 0 THEN [k1] ELSE ks END AS ks FROM t
), s AS (SELECT b, strict, bool_and(version IS NOT NULL) AS complete FROM (SELECT b, strict, unnest(ks) AS k FROM u) LEFT JOIN cu USING (k) GROUP BY b, strict)
SELECT 'current' AS what, 's' || k AS id, version::BIGINT AS n, NULL AS complete, NULL AS strict FROM cu
UNION ALL SELECT 'rows', 's' || l_orderkey, count(*), NULL, NULL FROM lineitem JOIN ex ON k = l_orderkey AND inside AND NOT lost GROUP BY l_orderkey
UNION ALL SELECT 'versions', 's' || k, held::INT + inside::INT, NULL, NULL FROM ex WHERE held OR inside
UNION ALL SELECT 'assessment', b, NULL, complete, complete AND strict FROM s""")
def renormalised_window(spark: SparkSession, d: str) -> DataFrame:
    """Two years of captures typed again: an order is a snapshot, its line items the rows, a customer's year a batch of two tries. Some snapshots had a row that the new rows lack and keep their version."""
    o, l = _read(spark, d, "orders"), _read(spark, d, "lineitem")
    snapshot = lambda c: F.concat(F.lit("s"), c)
    cell = lambda *v: F.concat_ws("|", F.concat(F.lit("book"), "l_suppkey"), *(x.cast("string") for x in v), F.lit(""))
    second, none = F.col("l_suppkey") % 7 + 1, F.lit("")
    body = l.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(cell(F.col("l_linenumber"), F.lit("0.5"), second, none, F.col("l_linenumber"), F.lit("0.5"), F.lit(2)))), "$").alias("body"))
    dated = o.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("captured_at"))
    exports = dated.join(body, F.col("o_orderkey") == F.col("l_orderkey")).select(snapshot("o_orderkey").alias("snapshot"), F.lit("yazhi").alias("market"), "captured_at", "body", "o_orderkey", "o_custkey")
    held = exports.where("o_orderkey % 3 != 0").select("snapshot", F.lit(1).alias("version"), F.col("captured_at").alias("normalized_at"), F.concat(F.lit("old-"), "snapshot").alias("record_id"), F.lit("accepted").alias("status"))
    changed = F.when((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") == 1), 3).otherwise(2)
    old = l.select(snapshot("l_orderkey").alias("snapshot"), F.lit(1).alias("version"), *(v.cast("decimal(18,8)").alias(n) for n, v in zip(pipelines.SIGNATURE, (F.col("l_linenumber"), second, F.col("l_linenumber"), changed), strict=True)))
    start, end = F.lit("1994-01-01").cast("timestamp"), F.lit("1996-01-01").cast("timestamp")
    inside = exports.where((F.col("captured_at") >= start) & (F.col("captured_at") < end))
    years = inside.groupBy(F.concat(F.lit("b"), "o_custkey", F.lit("-"), F.year("captured_at")).alias("batch_id"), "o_custkey").agg(F.min("captured_at").alias("first_at"), F.max("captured_at").alias("last_at"), F.collect_list("snapshot").alias("all"), F.min_by("snapshot", F.struct("captured_at", "o_orderkey")).alias("one"))
    tries = F.array(F.struct(F.col("first_at").alias("completed_at"), F.array("one").alias("snapshots"), F.lit(True).alias("strict_eligible")), F.struct(F.col("last_at").alias("completed_at"), F.col("all").alias("snapshots"), (F.col("o_custkey") % 4 != 0).alias("strict_eligible")))
    batches = years.select("batch_id", F.explode(tries).alias("t")).select("batch_id", "t.*")
    got = pipelines.renormalise_window(exports, held, old, batches, start, end, 2, F.lit("2026-01-01").cast("timestamp"))
    row = lambda what, df, key, n, complete=F.lit(None), strict=F.lit(None): df.select(F.lit(what).alias("what"), F.col(key).alias("id"), n.cast("long").alias("n"), complete.cast("boolean").alias("complete"), strict.cast("boolean").alias("strict"))
    count = lambda df: df.groupBy("snapshot").agg(F.count("*").alias("n"))
    return (
        row("current", got["current"], "snapshot", F.col("version")).unionByName(row("rows", count(got["rows"]), "snapshot", F.col("n"))).unionByName(row("versions", count(got["versions"]), "snapshot", F.col("n")))
        .unionByName(row("assessment", got["assessments"], "batch_id", F.lit(None), F.col("data_complete"), F.col("model_strict_eligible")))
    )


# --- contracts, files, states ------------------------------------------------------------------------------------------


@_query("""WITH g AS (SELECT o_orderstatus AS grp, count(*) AS n, count(DISTINCT o_custkey) AS n_keys FROM orders GROUP BY 1), e AS (SELECT grp, CASE WHEN grp = 'O' THEN n + 1 ELSE n END AS expected FROM g WHERE grp <> 'P' UNION ALL SELECT 'X', 5)
SELECT grp, coalesce(expected, 0) AS expected, coalesce(n, 0) AS n, coalesce(n_keys, 0) AS n_keys, coalesce(n, 0) = coalesce(expected, 0) AND coalesce(n_keys, 0) = coalesce(n, 0) AS ok FROM g FULL JOIN e USING (grp)""")
def pinned_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a pinned dataset: one group as expected, one short, one not expected, one missing."""
    o = _read(spark, d, "orders")
    have = {r["o_orderstatus"]: r["n"] for r in o.groupBy("o_orderstatus").agg(F.count("*").alias("n")).collect()}
    expected = {k: n + (k == "O") for k, n in have.items() if k != "P"} | {"X": 5}
    return contracts.dataset_contract(o, "o_custkey", "o_orderstatus", expected)


@_query("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS line, ['ouzhi', 'yazhi', 'daxiao', 'ouzhi'][(l_linenumber % 4 + 1)::INT] AS m, l_suppkey % 4 AS gap FROM lineitem)
SELECT k, line, m AS market, CASE m WHEN 'ouzhi' THEN gap NOT IN (0, 1) WHEN 'yazhi' THEN gap NOT IN (1, 2) ELSE gap NOT IN (2, 3) END AS complete FROM r""")
def complete_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that have all prices of their market; of each row one price is missing, by its supplier."""
    gap = F.col("l_suppkey") % 4
    rows = _market_rows(_read(spark, d, "lineitem"))
    lacks = {"opening_draw": gap == 0, "current_home": gap == 1, "opening_line": gap == 2, "current_under": gap == 3}
    rows = rows.withColumns({c: F.when(~missing, F.col(c)) for c, missing in lacks.items()})
    return rows.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), "market", contracts.complete_row().alias("complete"))


@_query("""WITH f AS (SELECT user_id % 16 AS part, sha256(string_agg(event_id::VARCHAR || chr(10), '' ORDER BY event_id)) AS sha256, sum(length(event_id::VARCHAR) + 1)::BIGINT AS size FROM events GROUP BY 1)
SELECT part, size, sha256, CASE WHEN part % 4 = 0 THEN 'new' WHEN part % 4 = 1 THEN 'changed' ELSE 'existing' END AS status, part % 5 <> 0 AND part % 4 <> 1 AS complete FROM f""")
def stored_files(spark: SparkSession, d: str) -> DataFrame:
    """Files hashed where they are read, against stored hashes, and the completeness of runs that list them: a run of every fifth part lists another size."""
    rows = _read(spark, d, "events").select(_text("event_id").alias("value"), (F.col("user_id") % 16).alias("part"), F.lit(0).alias("chunk"), "event_id")
    found = facts.blobs(spark, _written(rows), "*.txt").withColumn("part", F.expr(_PART[0].replace("file", "path").rsplit(" AS ", 1)[0]))
    part = F.col("part")
    stored = found.where(part % 4 != 0).select("path", F.when(part % 4 == 1, "other").otherwise(F.col("sha256")).alias("sha256"))
    status = facts.manifest_changes(found, stored).select("path", "status")
    listed = found.select(_text("part").alias("run_id"), "path", F.when(part % 5 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(part % 4 == 1, "other").otherwise(F.col("sha256")).alias("sha256"))
    done = facts.completed_runs(listed, found)
    return found.join(status, "path").join(done, _text("part") == F.col("run_id")).select("part", "size", "sha256", "status", "complete")


@_query("""WITH e AS (SELECT o_custkey AS k, o_orderdate AS seen, o_orderkey AS r, CASE WHEN o_orderkey % 50 = 0 THEN 'U' ELSE 'T' END AS team, o_orderdate + to_days((o_orderkey % 3)::INT) AS kick FROM orders), b AS (SELECT *, lag(team) OVER w AS t0, lag(kick) OVER w AS k0, row_number() OVER w AS i FROM e WINDOW w AS (PARTITION BY k ORDER BY seen, r)
), c AS (SELECT *, max(coalesce(t0 <> team, false)::INT) OVER (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING) AS bad, count(*) OVER (PARTITION BY k) AS n FROM b)
SELECT k AS fixture, CASE WHEN bad = 1 THEN 'identity_conflict' WHEN i = 1 THEN 'new' WHEN kick IS DISTINCT FROM k0 THEN 'kickoff_changed' ELSE 'unchanged' END AS status, r AS record, n AS observations, k % 9 = 0 AS excluded FROM c WHERE i = n""")
def rebuilt_states(spark: SparkSession, d: str) -> DataFrame:
    """The state of each fixture from its whole log: every order of a customer is an observation."""
    k = F.col("o_orderkey")
    log = _read(spark, d, "orders").select(F.col("o_custkey").alias("fixture"), F.col("o_orderdate").alias("at"), k.alias("record"), F.when(k % 50 == 0, "U").otherwise("T").alias("team"), (F.col("o_orderdate") + F.make_dt_interval((k % 3).cast("int"))).alias("kick"))
    got = states.rebuild(log, "fixture", "at", "record", "team", "kick", [], log.where("fixture % 9 = 0"))
    return got.select("fixture", "status", "record", "observations", "excluded")


@_query("""WITH t AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < DATE '1996-01-01'), e AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT k AS fixture, 'left' AS side, (SELECT count(*) FROM t JOIN e USING (k)) = 0 AS disjoint FROM t WHERE k NOT IN (SELECT k FROM e) UNION ALL SELECT k, 'right', (SELECT count(*) FROM t JOIN e USING (k)) = 0 FROM e WHERE k NOT IN (SELECT k FROM t)""")
def set_differences(spark: SparkSession, d: str) -> DataFrame:
    """Customers of one period alone, and whether the periods have none in common."""
    o = _read(spark, d, "orders").select(F.col("o_custkey").alias("fixture"), F.col("o_orderdate").alias("at"))
    a, b = score.split_by_date(o, "at", "1996-01-01")
    return evidence.differences(a, b, ["fixture"]).withColumn("disjoint", F.lit(evidence.disjoint(a, b, "fixture")))


@_query("""WITH n AS (SELECT DISTINCT n_nationkey AS k, n_name FROM nation), y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), c AS (SELECT c_nationkey AS k, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT k || '-' || y AS asset_id, 'season_csv' AS kind, n_name AS competition, y::VARCHAR AS season, coalesce(c.n, 0) AS fixtures FROM n CROSS JOIN y LEFT JOIN c USING (k, y) UNION ALL SELECT 'r' || r_regionkey, 'extra_csv', r_name, NULL, 0 FROM region""")
def asset_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Season files of each nation and year and an extra one of each region, with the fixtures that they have."""
    o, c = _read(spark, d, "orders"), _read(spark, d, "customer")
    leagues = {str(r["n_nationkey"]): r["n_name"] for r in _read(spark, d, "nation").collect()}
    seasons = sorted(str(r["y"]) for r in o.select(F.year("o_orderdate").alias("y")).distinct().collect())
    extra = {f"r{r['r_regionkey']}": r["r_name"] for r in _read(spark, d, "region").collect()}
    n = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.concat_ws("-", "c_nationkey", F.year("o_orderdate")).alias("asset_id")).agg(F.count("*").alias("fixtures"))
    return odds_files.catalogue(spark, leagues, seasons, extra).join(n, "asset_id", "left").select("asset_id", "kind", "competition", "season", F.coalesce("fixtures", F.lit(0)).alias("fixtures"))


@_query("""SELECT o_orderpriority AS competition, count(*) AS sample_size, round(avg((o_orderstatus = 'F')::INT), 8) AS home_rate FROM orders GROUP BY 1""")
def stored_report(spark: SparkSession, d: str) -> DataFrame:
    """A report as JSON, read again; writing it twice leaves one."""
    found = _fixtures(spark, d).groupBy("competition").agg(F.count("*").alias("sample_size"), F.round(F.avg((F.col("actual") == 0).cast("int")), 8).alias("home_rate"))
    path = folder(spark)
    for _ in range(2):
        facts.report(found, path)
    return spark.read.schema("competition string, sample_size long, home_rate double").json(path)
