"""Registered queries of the library over the tables at hand, and the SQL that gives the same rows.

Prices are read from line items: a fixture is an order, a bookmaker a supplier, kickoff the order date,
an observation the ship date, the outcome follows from the order's status, the competition is its
priority. Doubles are rounded to 8 places, so that the order of sums does not show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritide.functions import ids, odds, parse
from veritide.operators import asof, contracts, evidence, market, reports, rules, score, versions
from veritide.streaming import states

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _r(name: str, places: int = 8):
    return F.round(F.col(name), places).alias(name)


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("fixture"), F.col("l_suppkey").alias("book"), (1.5 + F.col("l_discount") * 10).alias("home"), (3 + F.col("l_tax") * 10).alias("draw"), (1.2 + F.col("l_quantity") / 10).alias("away"),
        F.col("l_shipdate").alias("observed_at"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
    )


def _fixtures(spark: SparkSession, d: str) -> DataFrame:
    actual = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return _read(spark, d, "orders").select(F.col("o_orderkey").alias("fixture"), F.col("o_orderpriority").alias("competition"), F.col("o_orderdate").alias("kickoff"), actual.alias("actual"), F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price"))


#: Repeated quotes of a bookmaker: the greatest (line, part, prices) stays.
_Q = """q AS (
  SELECT l_orderkey AS fixture, l_suppkey AS book, 1.5 + l_discount * 10 AS home, 3 + l_tax * 10 AS draw, 1.2 + l_quantity / 10 AS away, l_shipdate AS observed_at, l_linenumber AS line, l_partkey AS part FROM lineitem
), fx AS (
  SELECT o_orderkey AS fixture, o_orderpriority AS competition, o_orderdate AS kickoff, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS actual, o_custkey AS custkey, o_totalprice AS price FROM orders
)"""
_D = _Q + """, dv AS (
  SELECT *, (1/home) / (1/home + 1/draw + 1/away) AS ph, (1/draw) / (1/home + 1/draw + 1/away) AS pd, (1/away) / (1/home + 1/draw + 1/away) AS pa, 1/home + 1/draw + 1/away AS margin FROM q
), one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fixture, book ORDER BY line DESC, part DESC, home DESC, draw DESC, away DESC) AS rn FROM dv) WHERE rn = 1
), md AS (
  SELECT fixture, median(ph) AS mh, median(pd) AS mdr, median(pa) AS ma, count(*) AS bookmakers FROM one GROUP BY fixture
), cs AS (
  SELECT fixture, bookmakers, mh, mdr, ma, mh / (mh + mdr + ma) AS ch, mdr / (mh + mdr + ma) AS cd, ma / (mh + mdr + ma) AS ca FROM md WHERE bookmakers >= 3
)"""


def _quoted(spark: SparkSession, d: str) -> DataFrame:
    rows = _quotes(spark, d).withColumn("rec", F.struct("line", "part", "home", "draw", "away"))
    return market.quotes(rows, ["fixture"], "book", ("home", "draw", "away"), "positive", "rec")


def _agreed(spark: SparkSession, d: str) -> DataFrame:
    return market.consensus(_quoted(spark, d), ["fixture"], "book")


@_query(f"""WITH {_D}, s AS (
  SELECT competition, actual, ch, cd, ca FROM cs JOIN fx USING (fixture)
) SELECT competition, count(*) AS n, round(avg(-ln(greatest(CASE actual WHEN 0 THEN ch WHEN 1 THEN cd ELSE ca END, 1e-15))), 8) AS log_loss,
  round(avg((ch - (actual = 0)::INT) ** 2 + (cd - (actual = 1)::INT) ** 2 + (ca - (actual = 2)::INT) ** 2), 8) AS brier,
  round(avg(((ch - (actual = 0)::INT) ** 2 + (ch + cd - (actual <= 1)::INT) ** 2) / 2), 8) AS rps FROM s GROUP BY competition""")
def consensus_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = score.scored(_agreed(spark, d).join(_fixtures(spark, d), "fixture"))
    return rows.groupBy("competition").agg(*score.metrics()).select("competition", F.col("sample_size").alias("n"), _r("log_loss"), _r("brier"), _r("rps"))


@_query(f"""WITH {_D}, ds AS (
  SELECT o.fixture, greatest(median(abs(ph - mh)), median(abs(pd - mdr)), median(abs(pa - ma))) AS dispersion FROM one o JOIN md USING (fixture) GROUP BY o.fixture
) SELECT fixture, bookmakers, round(ch, 8) AS p_home, round(cd, 8) AS p_draw, round(ca, 8) AS p_away, round(list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2], 8) AS gap, round(dispersion, 8) AS dispersion,
  CAST(CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS INTEGER) AS favourite, round(ln(ch / cd), 8) AS log_home_draw FROM cs JOIN ds USING (fixture)""")
def consensus_features(spark: SparkSession, d: str) -> DataFrame:
    a = _agreed(spark, d)
    return a.select("fixture", "bookmakers", *(F.round(F.col("p")[i], 8).alias(f"p_{s}") for i, s in enumerate(odds.SIDES)), _r("gap"), _r("dispersion"), odds.favourite("p").alias("favourite"), F.round(odds.log_ratios("p")["home_draw"], 8).alias("log_home_draw"))


@_query(f"""WITH {_D}, h AS (SELECT *, max((book % 5 = 0)::INT) OVER (PARTITION BY fixture) AS has FROM one WHERE book % 7 <> 3),
u AS (SELECT fixture, count(*) AS bookmakers, avg(ph) AS a, avg(pd) AS b, avg(pa) AS c FROM h WHERE has = 0 OR book % 5 = 0 GROUP BY fixture)
SELECT fixture, bookmakers, round(a / (a + b + c), 8) AS p_home, round(b / (a + b + c), 8) AS p_draw, round(c / (a + b + c), 8) AS p_away FROM u""")
def average_consensus(spark: SparkSession, d: str) -> DataFrame:
    q = _quoted(spark, d).withColumn("name", F.when(F.col("book") % 7 == 3, "Max").when(F.col("book") % 5 == 0, "Avg").otherwise("other"))
    a = market.average_consensus(q, ["fixture"], "name")
    return a.select("fixture", "bookmakers", *(F.round(F.col("p")[i], 8).alias(f"p_{s}") for i, s in enumerate(odds.SIDES)))


@_query(f"""WITH {_D}, g AS (SELECT o.fixture, book, ph - ch AS eh, pd - cd AS ed, pa - ca AS ea FROM one o JOIN cs USING (fixture)
), m AS (SELECT *, count(*) OVER w AS n, median(abs(eh)) OVER w AS m0, median(abs(ed)) OVER w AS m1, median(abs(ea)) OVER w AS m2 FROM g WINDOW w AS (PARTITION BY fixture)
), z AS (SELECT *, greatest(abs(eh), abs(ed), abs(ea)) AS most,
  coalesce(abs(CASE WHEN m0 > 0 THEN 0.6745 * eh / m0 END) >= 3.5, false) OR coalesce(abs(CASE WHEN m1 > 0 THEN 0.6745 * ed / m1 END) >= 3.5, false) OR coalesce(abs(CASE WHEN m2 > 0 THEN 0.6745 * ea / m2 END) >= 3.5, false) AS outlier,
  (m0 = 0 AND abs(eh) >= 0.03) OR (m1 = 0 AND abs(ed) >= 0.03) OR (m2 = 0 AND abs(ea) >= 0.03) AS zero FROM m)
SELECT fixture, book, round(most, 8) AS max_deviation, n >= 5 AND most >= 0.03 AND (outlier OR zero) AS anomaly FROM z""")
def bookmaker_anomalies(spark: SparkSession, d: str) -> DataFrame:
    q = _quoted(spark, d)
    a = market.anomalies(q, market.consensus(q, ["fixture"], "book"), ["fixture"], "book")
    return a.select("fixture", "book", _r("max_deviation"), "anomaly")


@_query(f"""WITH {_D}, r AS (
  SELECT a.fixture, a.book AS left_out, median(b.ph) AS h, median(b.pd) AS d, median(b.pa) AS a FROM one a JOIN one b ON a.fixture = b.fixture AND a.book <> b.book GROUP BY a.fixture, a.book
), n AS (SELECT r.fixture, h / (h + d + a) AS h, d / (h + d + a) AS d, a / (h + d + a) AS a, ch, cd, ca FROM r JOIN cs USING (fixture))
SELECT fixture, round(max(greatest(abs(h - ch), abs(d - cd), abs(a - ca))), 8) AS max_shift, bool_or((CASE WHEN h >= d AND h >= a THEN 0 WHEN d >= a THEN 1 ELSE 2 END) <> (CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END)) AS direction_flip FROM n GROUP BY fixture""")
def leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    q = _quoted(spark, d)
    return market.leave_one_out(q, market.consensus(q, ["fixture"], "book"), ["fixture"], "book").select("fixture", _r("max_shift"), "direction_flip")


@_query(f"""WITH {_D} SELECT fixture, round(median(greatest(abs(ph - ch), abs(pd - cd), abs(pa - ca))), 8) AS dispersion FROM one JOIN cs USING (fixture) GROUP BY fixture""")
def peer_dispersion(spark: SparkSession, d: str) -> DataFrame:
    q = _quoted(spark, d)
    return market.peer_dispersion(q, market.consensus(q, ["fixture"], "book"), ["fixture"], "book").select("fixture", _r("dispersion"))


_EDGE = "row_number() OVER (PARTITION BY fixture, part % 7 ORDER BY observed_at {0}, line {0}, part {0}, book {0}, home {0}, draw {0}, away {0})"


@_query(f"""WITH {_D}, e AS (SELECT *, part % 7 AS grp, {_EDGE.format('')} AS a, {_EDGE.format('DESC')} AS z FROM dv
), p AS (SELECT x.fixture, x.grp, x.home AS oh, y.home AS nh, x.away AS oa, y.away AS na, x.ph AS qh, x.pd AS qd, x.pa AS qa, y.ph AS rh, y.pd AS rd, y.pa AS ra FROM e x JOIN e y ON x.fixture = y.fixture AND x.grp = y.grp AND x.a = 1 AND y.z = 1
), f AS (SELECT p.*, CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS fav FROM p JOIN cs USING (fixture)
), g AS (SELECT fixture, round(CASE fav WHEN 0 THEN rh - qh ELSE ra - qa END, 12) AS df, round(CASE fav WHEN 0 THEN ra - qa ELSE rh - qh END, 12) AS dopp, round(rd - qd, 12) AS dd, CASE fav WHEN 0 THEN nh - oh ELSE na - oa END AS od FROM f WHERE fav <> 1)
SELECT fixture, count(*) AS paired, round(median(df), 8) + 0 AS delta_p_favourite, round(median(od), 8) + 0 AS delta_favourite_odds, round(avg((df <= -0.015)::INT), 8) AS cooling_support, round(avg((df >= 0.010)::INT), 8) AS strengthening_support, round(avg((dd >= 0.0075 OR dopp >= 0.0075)::INT), 8) AS alternative_support FROM g GROUP BY fixture""")
def movement_features(spark: SparkSession, d: str) -> DataFrame:
    q = _quotes(spark, d).withColumn("grp", F.col("part") % 7)
    order = F.struct("observed_at", "line", "part", "book", "home", "draw", "away")
    price = F.struct("home", "draw", "away")
    pairs = q.groupBy("fixture", "grp").agg(F.min_by(price, order).alias("opening"), F.max_by(price, order).alias("current"))
    m = market.movement(pairs, ["fixture"], _agreed(spark, d))
    return m.select("fixture", "paired", *(_r(c) for c in m.columns[2:]))


@_query(f"""WITH {_D}, f AS (SELECT fixture, CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS fav FROM cs
), i AS (SELECT fixture, (line % 5 - 2) * 0.25 AS ln, home / 10 AS h, draw / 10 AS d, away / 10 AS a, fav FROM q JOIN f USING (fixture) WHERE fav <> 1
), k AS (SELECT *, CASE WHEN ln = 0 THEN 'zero' WHEN (fav = 0 AND ln >= 0) OR (fav = 2 AND ln <= 0) THEN 'wrong' ELSE 'valid' END AS kind, round(1 - 2 * (CASE fav WHEN 0 THEN h ELSE a END) / (h + d + a), 12) AS v FROM i)
SELECT fixture, count(*) FILTER (WHERE kind = 'valid') AS valid_count, count(*) FILTER (WHERE kind = 'zero') AS zero_line_count, count(*) FILTER (WHERE kind = 'wrong') AS direction_mismatch_count, round(coalesce(avg((v >= 0.10)::INT) FILTER (WHERE kind = 'valid'), 0), 8) AS conflict_support FROM k GROUP BY fixture""")
def cover_conflicts(spark: SparkSession, d: str) -> DataFrame:
    index = _quotes(spark, d).select("fixture", ((F.col("line") % 5 - 2) * 0.25).alias("line"), *((F.col(s) / 10).alias(s) for s in odds.SIDES))
    c = market.cover_conflict(index, ["fixture"], _agreed(spark, d))
    return c.select("fixture", "valid_count", "zero_line_count", "direction_mismatch_count", _r("conflict_support"))


@_query(f"""WITH {_D}, f AS (SELECT fixture, CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END AS fav FROM cs
), l AS (SELECT fixture, CASE fav WHEN 0 THEN -1 ELSE 1 END * (line % 4 - 1) * 0.25::DOUBLE AS cur, CASE fav WHEN 0 THEN -1 ELSE 1 END * (line - 3) * 0.25::DOUBLE AS opn FROM q JOIN f USING (fixture) WHERE fav <> 1)
SELECT fixture, count(*) AS paired_lines, round(median(cur), 8) + 0 AS favourite_line, round(median(cur - opn), 8) + 0 AS delta_line, round(avg((cur - opn <= -0.25)::INT), 8) AS retreat_support, round(avg((cur - opn <= 0)::INT), 8) AS not_strengthening FROM l GROUP BY fixture""")
def line_moves(spark: SparkSession, d: str) -> DataFrame:
    rows = _quotes(spark, d).select("fixture", ((F.col("line") - 3) * 0.25).alias("opening_line"), ((F.col("line") % 4 - 1) * 0.25).alias("current_line"))
    m = market.line_movement(rows, ["fixture"], _agreed(spark, d))
    return m.select("fixture", "paired_lines", *(_r(c) for c in m.columns[2:]))


_SCORED = _D + """, sc AS (
  SELECT fixture, competition, kickoff, actual, ch, cd, ca, greatest(ch, cd, ca) AS top, ((CASE WHEN ch >= cd AND ch >= ca THEN 0 WHEN cd >= ca THEN 1 ELSE 2 END) = actual)::INT AS hit,
    -ln(greatest(CASE actual WHEN 0 THEN ch WHEN 1 THEN cd ELSE ca END, 1e-15)) AS log_loss FROM cs JOIN fx USING (fixture)
)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return score.scored(_agreed(spark, d).join(_fixtures(spark, d), "fixture"))


@_query(f"""WITH {_SCORED}, b AS (SELECT competition, year(kickoff)::VARCHAR AS yr, log_loss, hit FROM sc)
SELECT coalesce(competition, 'all') AS competition, coalesce(yr, 'all') AS year, count(*) AS sample_size, round(avg(log_loss), 8) AS log_loss, round(avg(hit), 8) AS accuracy, CASE WHEN count(*) >= 100 THEN 'available' ELSE 'insufficient_sample' END AS conclusion
FROM b GROUP BY GROUPING SETS ((), (yr), (competition), (competition, yr))""")
def score_cube(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).withColumn("year", F.year("kickoff").cast("string"))
    return score.grouped_metrics(rows, [(), ("year",), ("competition",), ("competition", "year")]).select("competition", "year", "sample_size", _r("log_loss"), _r("accuracy"), "conclusion")


@_query(f"""WITH {_SCORED}, k AS (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY top, hit, fixture) AS rn, count(*) OVER (PARTITION BY competition) AS n FROM sc
), b AS (SELECT competition, (least(10, n) * rn - 1) // n AS bin, count(*) AS k, avg(top) AS c, avg(hit) AS h, min(n) AS n FROM k GROUP BY 1, 2)
SELECT competition, round(sum(k / n * abs(c - h)), 8) AS ece, sum(k)::BIGINT AS n FROM b GROUP BY competition""")
def calibration_error(spark: SparkSession, d: str) -> DataFrame:
    return score.calibration_error(_scored(spark, d), ["competition"]).select("competition", _r("ece"), "n")


@_query(f"""WITH {_Q}, w AS (SELECT fixture, competition, kickoff, actual, {', '.join(f"1 + coalesce(sum((actual = {k} AND year(kickoff) <= 1995)::INT) OVER (PARTITION BY competition ORDER BY kickoff, fixture ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c{k}" for k in range(3))} FROM fx)
SELECT fixture, round(c0 / (c0 + c1 + c2), 8) AS prior_home, round(c1 / (c0 + c1 + c2), 8) AS prior_draw, round(c2 / (c0 + c1 + c2), 8) AS prior_away FROM w""")
def running_prior(spark: SparkSession, d: str) -> DataFrame:
    p = score.running_prior(_fixtures(spark, d), ["competition"], ["kickoff", "fixture"], "actual", F.year("kickoff") <= 1995)
    return p.select("fixture", *(F.round(F.col("prior")[i], 8).alias(f"prior_{s}") for i, s in enumerate(odds.SIDES)))


@_query(f"""WITH {_SCORED}, g AS (SELECT competition, count(*) AS n, sum(hit) AS s FROM sc GROUP BY 1)
SELECT competition, n, s::BIGINT AS hits, round(((s / n + 2.705543454095404 / (2 * n)) - 1.6448536269514722 * sqrt(s / n * (1 - s / n) / n + 2.705543454095404 / (4 * n * n))) / (1 + 2.705543454095404 / n), 8) AS lower,
  round(((s / n + 2.705543454095404 / (2 * n)) + 1.6448536269514722 * sqrt(s / n * (1 - s / n) / n + 2.705543454095404 / (4 * n * n))) / (1 + 2.705543454095404 / n), 8) AS upper FROM g""")
def hit_intervals(spark: SparkSession, d: str) -> DataFrame:
    g = _scored(spark, d).groupBy("competition").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    w = score.wilson("hits", "n")
    return g.select("competition", "n", "hits", F.round(w["lower"], 8).alias("lower"), F.round(w["upper"], 8).alias("upper"))


@_query(f"""WITH {_SCORED}, g AS (SELECT competition, least(1.0, abs(avg(hit - top)) * 20) AS p FROM sc GROUP BY 1
), o AS (SELECT *, row_number() OVER (ORDER BY p, competition) AS i, count(*) OVER () AS m FROM g)
SELECT competition, round(p, 8) AS p, round(max(least(1.0, (m - i + 1) * p)) OVER (ORDER BY p, competition ROWS UNBOUNDED PRECEDING), 8) AS adjusted FROM o""")
def holm_adjusted(spark: SparkSession, d: str) -> DataFrame:
    g = _scored(spark, d).groupBy("competition").agg(F.least(F.lit(1.0), F.abs(F.avg(F.col("hit") - F.col("top"))) * 20).alias("p"))
    return score.holm(g, "p", "competition").select("competition", _r("p"), _r("adjusted"))


@_query(f"""WITH {_SCORED}, k AS (SELECT competition, hit - top AS v, row_number() OVER (PARTITION BY competition ORDER BY kickoff, fixture) <= count(*) OVER (PARTITION BY competition) // 2 AS f FROM sc)
SELECT competition, count(*) AS n, round(avg(v) FILTER (WHERE f), 8) AS first_half, round(avg(v) FILTER (WHERE NOT f), 8) AS second_half FROM k GROUP BY competition""")
def residual_halves(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).withColumn("v", F.col("hit") - F.col("top"))
    return score.halves(rows, ["competition"], ["kickoff", "fixture"], "v").select("competition", "n", _r("first_half"), _r("second_half"))


@_query(f"""WITH {_SCORED}, v AS (SELECT competition, strftime(kickoff, '%G-%V') AS week, sum(hit - top) AS s, count(*) AS n FROM sc GROUP BY 1, 2
), w AS (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY week) - 1 AS i, count(*) OVER (PARTITION BY competition) AS weeks, (sum(n) OVER (PARTITION BY competition))::BIGINT AS total FROM v
), g AS (SELECT DISTINCT competition, weeks, total FROM w), r AS (SELECT *, unnest(range(10000)) AS b FROM g), x AS (SELECT *, unnest(range(weeks)) AS slot FROM r
), dr AS (SELECT competition, b, ('0x' || substr(md5('1:' || competition || ':' || b || ':' || slot), 1, 8))::BIGINT % weeks AS i FROM x
), m AS (SELECT competition, b, sum(s) / sum(n) AS m FROM dr JOIN w USING (competition, i) GROUP BY 1, 2
), k AS (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY m, b) - 1 AS k FROM m
), o AS (SELECT competition, max(m) FILTER (WHERE k = 499) AS lower, max(m) FILTER (WHERE k = 9500) AS upper, (1 + count(*) FILTER (WHERE m >= 0)) / 10001 AS p FROM k GROUP BY 1)
SELECT competition, weeks, total AS n, round(lower, 8) AS lower, round(upper, 8) AS upper, round(p, 4) AS p_value FROM g JOIN o USING (competition)""")
def week_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).withColumn("v", F.col("hit") - F.col("top"))
    return score.block_bootstrap(rows, ["competition"], "kickoff", "v").select("competition", "weeks", "n", _r("lower"), _r("upper"), _r("p_value", 4))


@_query(f"""WITH {_SCORED}, y AS (SELECT competition, CASE WHEN year(kickoff) <= 1995 THEN 'a' ELSE 'b' END AS season, hit - top AS v FROM sc)
SELECT competition, count(*) FILTER (WHERE season = 'a') AS n0, round(avg(v) FILTER (WHERE season = 'a'), 8) AS r0, count(*) FILTER (WHERE season = 'b') AS n1, round(avg(v) FILTER (WHERE season = 'b'), 8) AS r1,
  CASE WHEN count(*) FILTER (WHERE season = 'a') < 30 OR count(*) FILTER (WHERE season = 'b') < 30 THEN 'insufficient_sample' WHEN sign(avg(v) FILTER (WHERE season = 'a')) = sign(avg(v) FILTER (WHERE season = 'b')) THEN 'same_sign' ELSE 'opposite_sign' END AS status FROM y GROUP BY competition""")
def temporal_stability(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).select("competition", F.when(F.year("kickoff") <= 1995, "a").otherwise("b").alias("season"), (F.col("hit") - F.col("top")).alias("v"))
    return score.stability(rows, ["competition"], "season", "v", ("a", "b"), 30).select("competition", "n0", _r("r0"), "n1", _r("r1"), "status")


_BINS = """CASE WHEN round(top, 9) < 0.40 THEN '<0.40' WHEN round(top, 9) < 0.45 THEN '0.40-0.45' WHEN round(top, 9) < 0.50 THEN '0.45-0.50' WHEN round(top, 9) < 0.55 THEN '0.50-0.55' ELSE '>=0.55' END AS probability_bin,
  CASE WHEN gap < 0.05 THEN '<0.05' WHEN gap < 0.10 THEN '0.05-0.10' WHEN gap < 0.20 THEN '0.10-0.20' ELSE '>=0.20' END AS gap_bin,
  CASE WHEN ln = 0 THEN 'level' WHEN ln IN (0.25, 0.5) THEN 'shallow' WHEN ln IN (0.75, 1.0) THEN 'medium' ELSE 'deep' END AS line_bucket, CASE WHEN tot <= 2 THEN '<=2.00' WHEN tot = 2.25 THEN '2.25' WHEN tot = 2.5 THEN '2.50' ELSE '>=2.75' END AS total_bucket"""
_SHAPES = f"""{_SCORED}, sh AS (
  SELECT fixture, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS top_outcome, top, round(list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2], 9) AS gap, (fixture % 6) * 0.25 AS ln, 2 + (fixture % 4) * 0.25 AS tot FROM sc
), bn AS (SELECT fixture, top_outcome, {_BINS} FROM sh)"""


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.select(
        "fixture", "kickoff", F.element_at(F.array(*map(F.lit, odds.SIDES)), odds.favourite("p") + 1).alias("top_outcome"), odds.probability_bin(F.round("top", 9)).alias("probability_bin"), odds.gap_bin(F.round("gap", 9)).alias("gap_bin"),
        odds.line_bucket((F.col("fixture") % 6) * 0.25).alias("line_bucket"), odds.total_bucket(2 + (F.col("fixture") % 4) * 0.25).alias("total_bucket"),
    )


_LV = score.LEVELS[False]


@_query(f"""WITH {_SHAPES}, ti AS (SELECT bn.*, kickoff FROM bn JOIN fx USING (fixture)), {', '.join(f"e{i} AS (SELECT {', '.join([*fs, ''])}kickoff, count(*) AS k FROM ti GROUP BY ALL), s{i} AS (SELECT {', '.join([*fs, ''])}kickoff, sum(k) OVER ({('PARTITION BY ' + ', '.join(fs)) if fs else ''} ORDER BY kickoff RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 7 DAY PRECEDING) AS n FROM e{i}), c{i} AS (SELECT q.fixture, {i} AS i, '{n}' AS level, coalesce(h.n, 0)::BIGINT AS n FROM ti q JOIN s{i} h ON {' AND '.join(f'q.{f} = h.{f}' for f in ('kickoff', *fs))})" for i, (n, fs) in enumerate(_LV))},
u AS ({' UNION ALL '.join(f'SELECT * FROM c{i}' for i in range(len(_LV)))}), r AS (SELECT *, row_number() OVER (PARTITION BY fixture ORDER BY i) AS rn FROM u WHERE n >= 30 OR i = {len(_LV) - 1})
SELECT fixture, level, n, i > 0 AS fallback FROM r WHERE rn = 1""")
def cohort_fallback(spark: SparkSession, d: str) -> DataFrame:
    b = _shapes(spark, d).withColumn("label_at", F.col("kickoff") + F.expr("INTERVAL 7 DAYS"))
    return score.cohorts(b, b, "fixture", cutoff="kickoff", label_at="label_at")


@_query(f"""WITH {_SHAPES}, {', '.join(f"h{i} AS (SELECT {', '.join([*fs, ''])}count(*) AS n FROM bn JOIN fx USING (fixture) WHERE kickoff < TIMESTAMP '1998-01-01' GROUP BY ALL), c{i} AS (SELECT q.fixture, {i} AS i, '{n}' AS level, coalesce(h.n, 0) AS n FROM bn q LEFT JOIN h{i} h ON {' AND '.join(f'q.{f} = h.{f}' for f in fs) or 'true'})" for i, (n, fs) in enumerate(_LV))},
u AS ({' UNION ALL '.join(f'SELECT * FROM c{i}' for i in range(len(_LV)))}), r AS (SELECT *, row_number() OVER (PARTITION BY fixture ORDER BY i) AS rn FROM u WHERE n >= 30 OR i = {len(_LV) - 1})
SELECT fixture, level, n, i > 0 AS fallback FROM r WHERE rn = 1""")
def cohort_levels(spark: SparkSession, d: str) -> DataFrame:
    b = _shapes(spark, d)
    return score.cohorts(b, score.split_by_date(b, "kickoff", "1998-01-01")[0], "fixture")


@_query(f"""WITH {_SCORED}, pr AS (SELECT *, CASE abs(hash) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'B' END AS tier FROM (SELECT cs.*, d.dispersion, fixture % 9 AS hash, list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2] AS gap FROM cs JOIN (SELECT o.fixture, greatest(median(abs(ph - mh)), median(abs(pd - mdr)), median(abs(pa - ma))) AS dispersion FROM one o JOIN md USING (fixture) GROUP BY o.fixture) d USING (fixture))
), rw AS (SELECT *, CASE WHEN bookmakers >= 8 AND gap >= 0.15 AND dispersion <= 0.02 THEN 3 WHEN bookmakers >= 5 AND gap >= 0.07 AND dispersion <= 0.035 THEN 2 ELSE 1 END AS raw, CASE tier WHEN 'C' THEN 1 ELSE 3 END AS cap, fixture % 4 = 0 AS prov, fixture % 2 = 0 AS gate FROM pr
), fn AS (SELECT *, least(raw, cap, CASE WHEN prov THEN 2 ELSE 3 END, CASE WHEN gate THEN 3 ELSE 2 END) AS fin FROM rw)
SELECT fixture, ['low', 'medium', 'high'][raw] AS raw_confidence_label, ['low', 'medium', 'high'][fin] AS confidence_label,
  array_to_string(list_filter([CASE WHEN fin < raw THEN 'competition_confidence_cap' END, CASE WHEN NOT gate THEN 'insufficient_automatic_evaluation_sample' END, CASE WHEN prov THEN 'provisional_classification' END], lambda x: x IS NOT NULL), ',') AS reasons,
  array_to_string(list_filter([CASE WHEN dispersion > 0.035 THEN 'high_bookmaker_dispersion' END, CASE WHEN tier = 'C' THEN 'low_market_evidence_tier' END, CASE WHEN NOT gate THEN 'small_competition_evaluation_sample' END,
    CASE WHEN (CASE WHEN ch >= cd AND ch >= ca THEN ch WHEN ca > ch AND ca > cd THEN ca END) >= 0.58 AND cd >= 0.18 THEN 'strong_favorite_draw_tail' END, CASE WHEN gap < 0.07 THEN 'weak_direction_margin' END], lambda x: x IS NOT NULL), ',') AS risks FROM fn""")
def confidence_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("fixture")
    tier = F.when(k % 9 % 3 == 0, "A").when(k % 9 % 3 == 1, "C").otherwise("B")
    rows = _agreed(spark, d).select(
        "*", tier.alias("market_evidence_tier"), F.when(tier == "C", "low").otherwise("high").alias("confidence_cap"), F.when(k % 4 == 0, "provisional").otherwise("settled").alias("classification_status"), F.lit(False).alias("unregistered"), F.lit(False).alias("conflict"),
        F.when(k % 2 == 0, 200).otherwise(10).alias("verified_fixtures"), F.lit(90).alias("span_days"), F.lit("regular_time_only").alias("competition_format"),
    )
    c = rules.confidence(rows)
    return c.select("fixture", "raw_confidence_label", "confidence_label", F.array_join("confidence_reasons", ",").alias("reasons"), F.array_join("risk_flags", ",").alias("risks"))


def _first_features(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("fixture")
    a = _agreed(spark, d)
    return a.select(
        "fixture", "p", F.element_at(F.array(*map(F.lit, odds.SIDES)), odds.favourite("p") + 1).alias("favourite_side"), F.round("gap", 9).alias("gap"), F.round("dispersion", 9).alias("dispersion"), ((k % 5) * 0.25 - 0.25).alias("favourite_line"), ((k % 3) * -0.25).alias("delta_line"),
        ((k % 7 - 3) * 0.01).alias("delta_p_favourite"), ((k % 4) * 0.02).alias("delta_favourite_odds"), *((k % m / m).alias(n) for n, m in (("cooling_support", 5), ("strengthening_support", 4), ("alternative_support", 3), ("retreat_support", 6), ("not_strengthening", 2))),
        (2 + (k % 4) * 0.25).alias("total_line"), (k % 6).alias("valid_count"), (k % 8 / 8).alias("conflict_support"), (k % 5).alias("observation_count"), (k % 3 * 1000).alias("span_seconds"), (k % 3 * 0.25).alias("line_range"), (k % 4 * 0.01).alias("probability_range"),
        F.when(k % 20 == 0, F.array(F.lit("missing_snapshot"))).otherwise(F.array().cast("array<string>")).alias("hard_reasons"),
    )


@_query(f"""WITH {_D}, ds AS (SELECT o.fixture, round(greatest(median(abs(ph - mh)), median(abs(pd - mdr)), median(abs(pa - ma))), 9) AS dispersion FROM one o JOIN md USING (fixture) GROUP BY o.fixture
), f AS (SELECT fixture AS k, ch, cd, ca, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS side, round(list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2], 9) AS gap, dispersion FROM cs JOIN ds USING (fixture)
), x AS (SELECT *, side <> 'draw' AS dir, (k % 5) * 0.25 - 0.25 AS ln, round((k % 7 - 3) * 0.01, 12) AS dp FROM f
), y AS (SELECT *, dir AND abs(ln) IN (0.25, 0.5) AND dp <= -0.015 AND round((k % 4) * 0.02, 12) >= 0.03 AND k % 5 / 5 >= 0.6 AND k % 3 / 3 >= 0.6 AS r1, dir AND (CASE side WHEN 'home' THEN ch ELSE ca END) >= 0.45 AND gap >= 0.07 AS clear FROM x
), z AS (SELECT *, clear AND (k % 3) * -0.25 <= -0.25 AND k % 6 / 6 >= 0.6 AS r2, clear AND dp >= 0.01 AND k % 4 / 4 >= 0.6 AND ln = 0 AND k % 2 / 2 >= 0.6 AS r2f, 2 + (k % 4) * 0.25 <= 2.25 AND cd >= 0.28 AND abs(ln) <= 0.5 AS r3, k % 6 >= 3 AND k % 8 / 8 >= 0.6 AS r4,
  k % 5 >= 3 AND k % 3 * 1000 >= 1800 AND k % 3 * 0.25 <= 0.25 AND k % 4 * 0.01 <= 0.015 AS r5, dispersion > 0.035 AS r6 FROM y)
SELECT k AS fixture, CASE WHEN k % 20 = 0 OR ((r1 OR r2) AND (r3 OR r4 OR r6)) THEN 'abstain' WHEN r1 OR r2 THEN 'downgrade' WHEN r2f OR r3 OR r4 OR r6 OR r5 THEN 'caution' ELSE 'keep' END AS action,
  CASE WHEN k % 20 = 0 THEN 'r0_data_integrity' ELSE array_to_string(list_filter([CASE WHEN r1 THEN 'r1_shallow_favorite_cooling' END, CASE WHEN r2 THEN 'r2_asian_retreat' END, CASE WHEN r2f THEN 'r2_euro_strong_asian_flat' END, CASE WHEN r3 THEN 'r3_low_total_draw_tail' END, CASE WHEN r4 THEN 'r4_handicap_cover_conflict' END, CASE WHEN r5 THEN 'r5_live_market_stability' END, CASE WHEN r6 THEN 'r6_bookmaker_dispersion' END], lambda v: v IS NOT NULL), ',') END AS flags FROM z""")
def first_guardrail(spark: SparkSession, d: str) -> DataFrame:
    g = rules.first_guardrail(_first_features(spark, d))
    return g.select("fixture", F.col("proposed_action").alias("action"), F.array_join("rule_flags", ",").alias("flags"))


@_query(f"""WITH {_D}, f AS (SELECT fixture AS k, CASE WHEN ch >= cd AND ch >= ca THEN 'home' WHEN cd >= ca THEN 'draw' ELSE 'away' END AS side, round(list_sort([ch, cd, ca], 'DESC')[1] - list_sort([ch, cd, ca], 'DESC')[2], 9) AS gap, bookmakers AS n FROM cs
), x AS (SELECT *, side = 'draw' AS dr, n < 5 AS few, gap < 0.07 AS weak, k % 5 / 5 >= 0.6 AS sup, k % 3 / 3 >= 0.6 AS con, k % 7 / 7 >= 0.6 AS cfl, k % 6 * 0.01 > 0.035 AS wide, k % 4 >= 3 AND k % 2 * 2000 >= 1800 AS ready, k % 11 = 0 AS iso, k % 13 = 0 AS dis, k % 17 = 0 AS inn, k % 8 = 0 AS unch, k % 9 = 0 AS flip, k % 5 * 0.01 >= 0.03 AS shift, k % 19 = 0 AS warn FROM f
), y AS (SELECT *, (cfl OR inn)::INT + wide::INT + iso::INT + (flip OR shift)::INT AS main, weak OR few OR NOT ready OR dis OR unch OR warn OR dr AS aux FROM x
), z AS (SELECT *, CASE WHEN (flip AND few) OR main >= 2 THEN 'abstain' WHEN main = 1 THEN 'downgrade' WHEN aux OR NOT sup OR (NOT dr AND NOT con) THEN 'caution' ELSE 'keep' END AS action FROM y)
SELECT k AS fixture, action, CASE action WHEN 'abstain' THEN 'observation_only' WHEN 'downgrade' THEN 'low' ELSE CASE WHEN NOT few AND NOT weak AND NOT wide THEN 'medium' ELSE 'low' END END AS cap FROM z""")
def second_guardrail(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("fixture")
    one = lambda n: F.when(k % n == 0, 1).otherwise(0)
    rows = _agreed(spark, d).select(
        "fixture", "p", F.element_at(F.array(*map(F.lit, odds.SIDES)), odds.favourite("p") + 1).alias("base_direction"), F.round("gap", 9).alias("gap"), (k % 6 * 0.01).alias("dispersion"), F.col("bookmakers").alias("paired"), (k % 5 / 5).alias("support_ratio"), (k % 3 / 3).alias("confirm_ratio"), (k % 7 / 7).alias("conflict_ratio"), (k % 2 * 0.25).alias("total_delta"),
        (k % 4).alias("observation_count"), (k % 2 * 2000).alias("span_seconds"), F.create_map(F.lit("isolated_move"), one(11), F.lit("persistent_dissent"), one(13), F.lit("internal_cross_market_conflict"), one(17), F.lit("unchanged_confirmed"), one(8)).alias("state_counts"), (k % 9 == 0).alias("direction_flip"), (k % 5 * 0.01).alias("max_shift"),
        F.when(k % 19 == 0, F.array(F.lit("w"))).otherwise(F.array().cast("array<string>")).alias("pairing_warnings"), F.array().cast("array<string>").alias("hard_reasons"),
    )
    g = rules.second_guardrail(rows)
    return g.select("fixture", F.col("proposed_action").alias("action"), F.col("proposed_confidence_cap").alias("cap"))


@_query(f"""WITH {_SCORED}, a AS (SELECT competition, hit, CASE fixture % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'caution' WHEN 2 THEN 'downgrade' ELSE 'abstain' END AS act FROM sc)
SELECT competition, count(*) AS fixtures, count(*) FILTER (WHERE hit = 0) AS wrong, count(*) FILTER (WHERE act <> 'keep') AS flagged, count(*) FILTER (WHERE act <> 'keep' AND hit = 1) AS false_warnings, round(count(*) FILTER (WHERE act <> 'keep' AND hit = 0) / count(*) FILTER (WHERE hit = 0), 8) AS capture_rate,
  round(round(count(*) FILTER (WHERE act <> 'keep' AND hit = 0) / count(*) FILTER (WHERE act <> 'keep'), 10) - round(count(*) FILTER (WHERE act = 'keep' AND hit = 0) / count(*) FILTER (WHERE act = 'keep'), 10), 8) AS lift FROM a GROUP BY competition""")
def guardrail_risk(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("fixture") % 4
    rows = _scored(spark, d).withColumn("proposed_action", F.when(k == 0, "keep").when(k == 1, "caution").when(k == 2, "downgrade").otherwise("abstain"))
    m = reports.risk_metrics(rows, ["competition"])
    return m.select("competition", "fixtures", "wrong", "flagged", "false_warnings", _r("capture_rate"), _r("lift"))


@_query("""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_user(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest(_read(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@_query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 3""")
def top_three(spark: SparkSession, d: str) -> DataFrame:
    return versions.top_k(_read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], 3).select("user_id", "event_type", "event_id")


@_query("""WITH n AS (SELECT user_id, event_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events), m AS (SELECT max(ts) - INTERVAL 7 DAY AS now FROM events)
SELECT user_id, event_id, event_type FROM (SELECT n.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM n, m WHERE ts <= now AND (until IS NULL OR until > now)) WHERE rn = 1""")
def active_at(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = e.withColumn("until", F.lead("ts").over(w)).crossJoin(F.broadcast(e.agg((F.max("ts") - F.expr("INTERVAL 7 DAYS")).alias("now"))))
    return versions.active(rows, ["user_id"], "ts", "until", F.col("now"), ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@_query("""SELECT l_orderkey, l_suppkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT (l_returnflag, l_linestatus)) = 1""")
def unanimous_lines(spark: SparkSession, d: str) -> DataFrame:
    return versions.unanimous(_read(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_returnflag", "l_linestatus"])


@_query("""WITH c AS (SELECT l_orderkey, l_suppkey, count(DISTINCT (l_discount, l_tax)) AS n, arg_min(l_partkey, (l_linenumber, l_partkey, l_quantity)) AS part FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_suppkey, CASE WHEN n = 1 THEN part END AS kept_part, n > 1 AS conflict FROM c""")
def deduplicated(spark: SparkSession, d: str) -> DataFrame:
    kept, bad = versions.deduplicate(_read(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_discount", "l_tax"], ["l_linenumber", "l_partkey", "l_quantity"])
    return kept.select("l_orderkey", "l_suppkey", F.col("l_partkey").alias("kept_part"), F.lit(False).alias("conflict")).unionByName(bad.select("l_orderkey", "l_suppkey", F.lit(None).cast("long").alias("kept_part"), F.lit(True).alias("conflict")))


@_query("""WITH x AS (SELECT user_id, event_type FROM (SELECT DISTINCT user_id, event_type, value > 50 AS v FROM events) GROUP BY 1, 2 HAVING count(*) > 1)
SELECT user_id, count(*) AS n FROM events e WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.user_id = e.user_id AND x.event_type = e.event_type) GROUP BY user_id""")
def stable_members(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").withColumn("big", F.col("value") > 50)
    return versions.unstable(e, ["user_id"], "event_type", ["big"])[0].groupBy("user_id").agg(F.count("*").alias("n"))


@_query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_responses(spark: SparkSession, d: str) -> DataFrame:
    return versions.first_response(_read(spark, d, "events"), ["user_id"], ["event_type", "props"], ["ts", "event_id"]).select("user_id", "event_id")


@_query("""SELECT user_id, count(*) AS observation_count, CAST(epoch(max(date_trunc('second', ts))) - epoch(min(date_trunc('second', ts))) AS BIGINT) AS span_seconds, round(max(value) - min(value), 8) AS value_range FROM events GROUP BY user_id""")
def trajectories(spark: SparkSession, d: str) -> DataFrame:
    return versions.trajectory(_read(spark, d, "events"), ["user_id"], "ts", ["value"]).select("user_id", "observation_count", "span_seconds", _r("value_range"))


@_query("""WITH a AS (SELECT *, value / 1000 AS v, value / 1000 - 0.05 AS dev FROM events), b AS (SELECT *, abs(v - (lag(v) OVER w + lead(v) OVER w) / 2) AS bend FROM a WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
), g AS (SELECT user_id, event_type, count(*) AS n, epoch(max(date_trunc('second', ts))) - epoch(min(date_trunc('second', ts))) AS span, max(v) - min(v) AS rng, min(abs(dev)) AS least, count(*) FILTER (WHERE dev > 0) AS up, abs(arg_min(v, (ts, event_id)) - arg_max(v, (ts, event_id))) AS ends, max(bend) AS spike FROM b GROUP BY 1, 2)
SELECT user_id, event_type, n, array_to_string(list_filter([CASE WHEN n >= 3 AND span >= 1800 AND rng <= 0.0025 THEN 'unchanged_confirmed' END, CASE WHEN n >= 3 AND span >= 1800 AND least >= 0.03 AND up IN (0, n) THEN 'persistent_dissent' END, CASE WHEN n >= 3 AND span >= 1800 AND ends <= 0.0025 AND spike >= 0.03 THEN 'one_off_spike' END], lambda x: x IS NOT NULL), ',') AS states FROM g""")
def series_states(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").withColumn("v", F.col("value") / 1000).withColumn("dev", F.col("v") - 0.05)
    s = versions.series_states(e, ["user_id", "event_type"], "ts", "event_id", "v", "dev")
    return s.select("user_id", "event_type", "n", F.array_join("states", ",").alias("states"))


@_query("""SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = 'error' AND x.value > 200 AND x.user_id = e.user_id)""")
def invalidated(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    return versions.without(e, states.invalidated(e.where("value > 200"), "user_id", "error"), ["user_id"]).select("event_id")


@_query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_orderstatus = 'F' AND x.o_orderkey + 1 = o.o_orderkey)""")
def not_superseded(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").withColumn("supersedes", F.col("o_orderkey") + 1)
    return versions.not_superseded(o, "o_orderkey", "supersedes", F.col("o_orderstatus") == "F").select("o_orderkey")


@_query(f"""WITH {_Q}, k AS (SELECT q.*, kickoff - INTERVAL 1 DAY AS cutoff, observed_at + INTERVAL 3 DAY AS corrected_at, kickoff FROM q JOIN fx USING (fixture))
SELECT fixture, count(*) AS n, max(observed_at) AS latest FROM k WHERE observed_at <= cutoff AND (line % 3 <> 0 OR corrected_at <= cutoff) GROUP BY fixture""")
def known_rows(spark: SparkSession, d: str) -> DataFrame:
    k = _quotes(spark, d).join(_fixtures(spark, d), "fixture").withColumn("corrected_at", F.when(F.col("line") % 3 == 0, F.col("observed_at") + F.expr("INTERVAL 3 DAYS")))
    return asof.rows_as_of(k, F.col("kickoff") - F.expr("INTERVAL 1 DAY")).groupBy("fixture").agg(F.count("*").alias("n"), F.max("observed_at").alias("latest"))


@_query(f"""WITH {_Q}, j AS (SELECT fixture, book, line, observed_at, row_number() OVER (PARTITION BY fixture ORDER BY observed_at DESC, observed_at + to_days(line::INT) DESC, book DESC, part DESC, line DESC) AS rn FROM q JOIN fx USING (fixture) WHERE observed_at <= kickoff AND observed_at + to_days(line::INT) <= kickoff + INTERVAL 2 DAY)
SELECT fx.fixture, j.book, j.observed_at FROM fx LEFT JOIN j ON fx.fixture = j.fixture AND rn = 1""")
def two_clock_asof(spark: SparkSession, d: str) -> DataFrame:
    facts = _quotes(spark, d).withColumns({"done_at": F.col("observed_at") + F.make_dt_interval(F.col("line")), "rec": F.struct("book", "part", "line")})
    fx = _fixtures(spark, d).withColumn("available_at", F.col("kickoff") + F.expr("INTERVAL 2 DAYS"))
    j = asof.asof_join(fx, facts, ["fixture"], "fixture", "kickoff", "observed_at", "rec", ("available_at", "done_at"), ["book", "observed_at"])
    return j.select("fixture", "book", "observed_at")


@_query("""SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' - INTERVAL 1440 MINUTE GROUP BY o_custkey""")
def self_cutoff_identity(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").withColumn("kick", F.lit("1998-01-01").cast("timestamp"))
    return asof.self_cutoff(o, ["o_custkey"], 1440, "o_orderdate", "kick", "o_orderkey").select("o_custkey", "o_orderkey")


@_query(f"""WITH {_Q} SELECT count(*) AS n_rows, max(observed_at) AS latest, count(*) FILTER (WHERE observed_at > kickoff) AS observed_past, count(*) FILTER (WHERE observed_at + INTERVAL 1 DAY > kickoff) AS corrected_past FROM q JOIN fx USING (fixture)""")
def asof_audit(spark: SparkSession, d: str) -> DataFrame:
    k = _quotes(spark, d).join(_fixtures(spark, d), "fixture").withColumn("corrected_at", F.col("observed_at") + F.expr("INTERVAL 1 DAY"))
    return asof.asof_audit(k, F.col("kickoff"))


@_query(f"""WITH {_Q}, t(target, m, f) AS (VALUES {', '.join(f"('{k}', {m}, {f})" for k, (m, f) in asof.TARGETS.items())}), c AS (SELECT fixture, target, kickoff, kickoff - to_minutes(m) AS cutoff, f FROM fx, t)
SELECT target, count(*) AS n, min(cutoff - to_minutes(f)) AS first_window, max(least(cutoff + INTERVAL 10 MINUTE, kickoff - INTERVAL 1 MINUTE)) AS last_deadline FROM c GROUP BY target""")
def cutoff_plan(spark: SparkSession, d: str) -> DataFrame:
    return asof.cutoffs(_fixtures(spark, d), asof.targets(spark), "kickoff").groupBy("target").agg(F.count("*").alias("n"), F.min("window_start").alias("first_window"), F.max("deadline").alias("last_deadline"))


@_query("""WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, count(e.event_id) AS n FROM p LEFT JOIN events e ON e.user_id = p.user_id AND e.ts <= p.ts AND e.event_id <> p.event_id GROUP BY p.event_id""")
def label_history(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    q = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    h = e.select(F.col("event_id").alias("past_id"), "user_id", F.col("ts").alias("label_at"))
    return asof.labelled_counts(q, h, ["user_id"], "ts", "label_at", "event_id", "past_id")


@_query("""WITH p AS (SELECT user_id, min(ts) AS kick FROM events WHERE event_type = 'purchase' GROUP BY 1), j AS (SELECT event_id, CASE WHEN ts BETWEEN kick - INTERVAL 2 DAY AND kick THEN 'in_window' WHEN ts < kick - INTERVAL 2 DAY THEN 'early' ELSE 'late' END AS lateness FROM events JOIN p USING (user_id))
SELECT lateness, count(*) AS n FROM j GROUP BY lateness""")
def window_lateness(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    p = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("kick"))
    j = e.join(p, "user_id").withColumn("start", F.col("kick") - F.expr("INTERVAL 2 DAYS"))
    return states.lateness(j, "ts", "start", "kick").groupBy("lateness").agg(F.count("*").alias("n"))


@_query("""SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1999-12-31 16:00:00') AS day_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def local_day_counts(spark: SparkSession, d: str) -> DataFrame:
    return states.daily_counts(_read(spark, d, "events"), "ts", ["event_type"])


@_query("""WITH b AS (SELECT event_id, user_id, event_type, value, lag(event_type) OVER w AS t0, lag(CAST(value AS BIGINT) // 10) OVER w AS k0, CAST(value AS BIGINT) // 10 AS k, lag(event_id) OVER w AS e0, ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), c AS (SELECT *, max((e0 IS NOT NULL AND t0 = 'error' AND event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bad FROM b)
SELECT event_id, CASE WHEN e0 IS NULL THEN 'first' ELSE 'later' END AS place, k IS DISTINCT FROM k0 AS moved FROM c""")
def identity_series(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").select("event_id", "user_id", "ts", F.lit("x").alias("team"), F.floor(F.round(F.col("value")) / 10).alias("kick"), F.lit("m").alias("label"))
    s = states.identity_states(e, "user_id", "ts", "event_id", "team", "kick", ["label"])
    return s.select("event_id", F.when(F.col("status") == "new", "first").otherwise("later").alias("place"), (F.col("status").isin("new", "kickoff_changed")).alias("moved"))


@_query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS fixtures, count(*) FILTER (WHERE value > 50) AS high, round(count(*) FILTER (WHERE value > 50) / count(*), 6) AS success_rate FROM events GROUP BY event_type""")
def event_rates(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").withColumn("status", F.when(F.col("value") > 50, "high").otherwise("low"))
    p = reports.pivot_status(e, ["event_type"], "status", ["high", "low"]).select("event_type", "high", "success_rate")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("fixtures")).join(p, "event_type")


@_query("""SELECT 'status' AS dimension, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'year', year(o_orderdate)::VARCHAR, count(*) FROM orders GROUP BY 2""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").cast("string").alias("year"))
    return reports.coverage(o, ["status", "priority", "year"])


@_query(f"""WITH {_SCORED}, x AS (SELECT 'competition' AS dimension, competition AS value, hit, log_loss FROM sc UNION ALL SELECT 'half', CASE WHEN fixture % 3 = 0 THEN 'legacy_unclassified' ELSE (fixture % 2)::VARCHAR END, hit, log_loss FROM sc UNION ALL SELECT 'overall', 'all', hit, log_loss FROM sc)
SELECT dimension, value, count(*) AS n, round(avg(hit), 8) AS accuracy, round(avg(log_loss), 8) AS log_loss FROM x GROUP BY 1, 2""")
def evaluation_by_dimension(spark: SparkSession, d: str) -> DataFrame:
    half = F.when(F.col("fixture") % 3 != 0, F.col("fixture") % 2)
    m = [F.count("*").alias("n"), F.round(F.avg("hit"), 8).alias("accuracy"), F.round(F.avg("log_loss"), 8).alias("log_loss")]
    return reports.by_dimensions(_scored(spark, d), {"competition": F.col("competition"), "half": half}, m, "legacy_unclassified")


@_query(f"""WITH {_Q} SELECT competition, count(DISTINCT fixture) AS fixtures, round((epoch(max(kickoff)) - epoch(min(kickoff))) / 86400, 6) AS span_days FROM fx WHERE actual <> 2 GROUP BY competition""")
def evaluation_stats(spark: SparkSession, d: str) -> DataFrame:
    return reports.evaluation_stats(_fixtures(spark, d).withColumn("method", F.col("actual").cast("string")), ["competition"], "fixture", "kickoff", "method", ("2",))


@_query("""SELECT p_brand, count(p_retailprice) AS n, min(p_retailprice) AS least, round(median(p_retailprice), 8) AS median, max(p_retailprice) AS most FROM part GROUP BY p_brand""")
def distributions(spark: SparkSession, d: str) -> DataFrame:
    return reports.distribution(_read(spark, d, "part"), ["p_brand"], "p_retailprice").select("p_brand", "n", "least", _r("median"), "most")


@_query("""WITH c AS (SELECT o_orderkey, list_filter([CASE WHEN o_totalprice < 50000 THEN 'small' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'collection_not_eligible' END], lambda x: x IS NOT NULL) AS r, o_orderstatus AS s FROM orders)
SELECT s AS status, count(*) AS batches, count(*) FILTER (WHERE len(r) = 0) AS eligible, count(*) FILTER (WHERE len(list_filter(r, lambda x: x <> 'collection_not_eligible')) = 0) AS data_complete, count(*) FILTER (WHERE list_contains(r, 'small')) AS small FROM c GROUP BY s""")
def eligibility(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders")
    r = rules.codes((F.col("o_totalprice") < 50000, "small"), (F.col("o_orderstatus") == "P", "pending"), (F.col("o_orderpriority").startswith("1"), "collection_not_eligible"))
    e = reports.eligibility_breakdown(o.select(F.col("o_orderstatus").alias("status"), r.alias("reasons")), ["status"], "reasons")
    return e.select("status", "batches", "eligible", "data_complete", F.coalesce(F.try_element_at("reason_counts", F.lit("small")), F.lit(0)).alias("small"))


@_query("""WITH g AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN n IS NULL THEN 'fixture_missing' WHEN n > 1 THEN 'fixture_duplicate' WHEN s IN (5, 6) THEN 'cancelled' WHEN s <> 4 THEN 'not_finished' ELSE 'finished' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_linenumber + 3) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def feed_triage(spark: SparkSession, d: str) -> DataFrame:
    feed = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linenumber") + 3).alias("status_code"))
    return evidence.feed_triage(feed, _read(spark, d, "orders"), "o_orderkey")


@_query("""WITH j AS (SELECT o_orderkey, c_custkey, n_nationkey, r_regionkey, c_acctbal FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 11 <> 0) ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
), c AS (SELECT unnest(list_filter([CASE WHEN c_custkey IS NULL THEN 'missing_candidate' END, CASE WHEN n_nationkey IS NULL THEN 'missing_observation' END, CASE WHEN r_regionkey IS NULL THEN 'missing_link' END, CASE WHEN c_acctbal < 0 THEN 'incomplete_inventory' END], lambda x: x IS NOT NULL)) AS code FROM j) SELECT code, count(*) AS n FROM c GROUP BY code""")
def chain_codes(spark: SparkSession, d: str) -> DataFrame:
    c = _read(spark, d, "customer").where("c_custkey % 11 != 0")
    n = _read(spark, d, "nation").where("n_nationkey % 6 != 0")
    j = _read(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    ok = {"missing_candidate": F.col("c_custkey").isNotNull(), "missing_observation": F.col("n_nationkey").isNotNull(), "missing_link": F.col("r_regionkey").isNotNull(), "incomplete_inventory": F.coalesce(F.col("c_acctbal") >= 0, F.lit(True))}
    return contracts.violations(j, ok, "o_orderkey").groupBy("code").agg(F.count("*").alias("n"))


@_query("""WITH a AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS t FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_orderkey AS k2, o_custkey AS c, o_orderdate AS t2 FROM orders WHERE o_orderkey % 2 = 1
), j AS (SELECT a.k, k2, abs(epoch(t) - epoch(t2)) > 172800 * 15 AS late, count(k2) OVER (PARTITION BY k) AS n FROM a LEFT JOIN b ON a.c = b.c)
SELECT k AS fixture_id, min(CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'rejected:ambiguous' WHEN late THEN 'rejected:kickoff' ELSE 'accepted' END) AS status FROM j GROUP BY k""")
def tolerance_match(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("kickoff_at"), F.lit("A").alias("home_team"), F.lit("b ").alias("away_team"))
    a, b = o.where("o_orderkey % 2 = 0").withColumnRenamed("o_orderkey", "fixture_id"), o.where("o_orderkey % 2 = 1").withColumnRenamed("o_orderkey", "match_id")
    return evidence.tolerance_match(a, b, ["c"], 43200).select("fixture_id", "status")


@_query("""WITH a AS (SELECT l_orderkey, l_returnflag AS s, count(*) AS n FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1, 2), b AS (SELECT l_orderkey, l_returnflag AS s, count(*) AS m FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1, 2)
SELECT l_orderkey, bool_and(coalesce(m, 0) >= n) AS ok FROM a LEFT JOIN b USING (l_orderkey, s) GROUP BY l_orderkey""")
def multiset_parity(spark: SparkSession, d: str) -> DataFrame:
    l = _read(spark, d, "lineitem")
    return market.parity(l.where("l_linenumber % 2 = 0"), l.where("l_linenumber % 2 = 1"), "l_orderkey", ["l_returnflag"])


@_query("""WITH a AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 300000)
SELECT side, count(*) AS n FROM (SELECT 'left' AS side, k FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'right', k FROM b WHERE k NOT IN (SELECT k FROM a)) GROUP BY side""")
def inventory_difference(spark: SparkSession, d: str) -> DataFrame:
    c, o = _read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("k")), _read(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return evidence.differences(c, o, ["k"]).groupBy("side").agg(F.count("*").alias("n"))


@_query("""WITH x AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey + (c_custkey % 2) * 3 END AS ident FROM customer), y AS (SELECT x.*, n.n_nationkey AS by_id, m.n_nationkey AS by_alias FROM x LEFT JOIN nation n ON ident = n.n_nationkey LEFT JOIN nation m ON x.c_nationkey = m.n_nationkey)
SELECT c_custkey, CASE WHEN by_id IS NOT NULL AND by_alias <> by_id THEN 'conflict' WHEN by_id IS NOT NULL THEN 'by_id' WHEN ident IS NOT NULL THEN 'unregistered' WHEN by_alias IS NOT NULL THEN 'by_alias' ELSE 'unregistered' END AS resolution FROM y""")
def profile_resolution(spark: SparkSession, d: str) -> DataFrame:
    n = _read(spark, d, "nation").select(F.col("n_nationkey").alias("profile_id"), F.col("n_name").alias("alias"))
    c = _read(spark, d, "customer").join(_read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumn("ident", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey") + (F.col("c_custkey") % 2) * 3))
    return evidence.resolve(c, n, n, "ident", "n_name").select("c_custkey", "resolution")


@_query("""WITH k AS (SELECT l_orderkey AS f, l_linenumber AS line, 'Book  ' || l_suppkey % 20 AS raw, 'Book ' || l_suppkey % 20 AS nm, CASE WHEN l_linenumber % 3 <> 0 THEN CASE WHEN l_suppkey % 7 = 0 THEN 'x' ELSE (l_suppkey % 40)::VARCHAR END END AS id FROM lineitem
), p AS (SELECT DISTINCT f, nm, id FROM k WHERE id IS NOT NULL), c AS (SELECT *, count(*) OVER (PARTITION BY f, nm) AS ids, count(*) OVER (PARTITION BY f, id) AS names FROM p
), n AS (SELECT f, nm, bool_or(ids > 1 OR names > 1) AS gone, min(id) AS known FROM c GROUP BY f, nm
), w AS (SELECT DISTINCT f, unnest(list_filter([CASE WHEN ids > 1 THEN 'bookmaker_name_maps_multiple_ids:' || nm END, CASE WHEN names > 1 THEN 'bookmaker_id_maps_multiple_names:' || id END], lambda x: x IS NOT NULL)) AS warning FROM c)
SELECT k.f AS fixture, line, CASE WHEN coalesce(k.id, known) IS NOT NULL THEN 'id:' || coalesce(k.id, known) ELSE 'name:' || k.nm END AS bookmaker_key, NULL AS warning FROM k LEFT JOIN n ON n.f = k.f AND n.nm = k.nm WHERE NOT coalesce(gone, false)
UNION ALL SELECT f, NULL, NULL, warning FROM w""")
def bookmaker_identity(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the key of their bookmaker, and the contradictions of names and ids, whose rows are left out."""
    supp = F.col("l_suppkey")
    ident = F.when(F.col("l_linenumber") % 3 != 0, F.when(supp % 7 == 0, "x").otherwise((supp % 40).cast("string")))
    l = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("fixture"), F.col("l_linenumber").alias("line"), F.concat(F.lit(" Book  "), (supp % 20).cast("string")).alias("name"), ident.alias("id"))
    kept, warned = market.bookmaker_keys(l, ["fixture"], "name", "id")
    return kept.select("fixture", "line", "bookmaker_key", F.lit(None).cast("string").alias("warning")).unionByName(warned.select("fixture", "warning"), allowMissingColumns=True)


@_query("""SELECT event_id, sha256('event|' || event_id || '|' || event_type || '|' || 'None') AS id FROM events""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "events").select("event_id", ids.stable_id("event", "event_id", "event_type", F.lit(None)).alias("id"))


@_query("""SELECT l_orderkey, sha256(string_agg(m, chr(10) ORDER BY m)) AS evidence FROM (SELECT l_orderkey, l_linenumber || '-' || l_partkey || '-' || l_suppkey AS m FROM lineitem) GROUP BY l_orderkey""")
def evidence_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The rows behind an assessment are few by nature, as an order's line items are; a set without such a bound is for dataset_hash."""
    return _read(spark, d, "lineitem").groupBy("l_orderkey").agg(ids.set_hash(F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")).alias("evidence"))


@_query("""WITH m AS (SELECT sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey) AS m FROM lineitem), b AS (SELECT substr(m, 1, 3) AS bucket, sha256(string_agg(m, chr(10) ORDER BY m)) AS h, count(*) AS n FROM m GROUP BY 1) SELECT sha256(string_agg(h, chr(10) ORDER BY bucket)) AS dataset_hash, sum(n)::BIGINT AS members FROM b""")
def dataset_hash(spark: SparkSession, d: str) -> DataFrame:
    return ids.dataset_hash(_read(spark, d, "lineitem").select(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey").alias("m")), "m")


@_query("""SELECT l_orderkey, l_returnflag, sha256(string_agg(r, chr(10) ORDER BY r)) AS fingerprint, count(*) AS row_count FROM (SELECT l_orderkey, l_returnflag, '{"part":"' || l_partkey || '","value":"x' || (l_suppkey % 3) || '"}' AS r FROM lineitem) GROUP BY 1, 2""")
def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    l = _read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_partkey").alias("part"), F.concat(F.lit("x"), F.col("l_suppkey") % 3).alias("value"))
    return ids.fingerprint(l, ["l_orderkey", "l_returnflag"], ["value", "part"])


@_query("""SELECT event_id, CASE WHEN a > 0 THEN round(1 + a / 100, 6) WHEN a < 0 THEN round(1 + 100 / abs(a), 6) END AS decimal_odds, CASE WHEN home > away THEN 0 WHEN home = away THEN 1 ELSE 2 END AS outcome, CASE WHEN value < 7 THEN 'weak' WHEN value < 15 THEN 'moderate' ELSE 'strong' END AS strength
FROM (SELECT event_id, value, (event_id % 1001 - 500)::DOUBLE AS a, event_id % 4 AS home, event_id % 3 AS away FROM events)""")
def scalar_odds(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return _read(spark, d, "events").select("event_id", odds.american_to_decimal((k % 1001 - 500).cast("double")).alias("decimal_odds"), odds.outcome(k % 4, k % 3).alias("outcome"), odds.strength_label("value", 7, 15).alias("strength"))


@_query("""WITH t AS (SELECT event_id, ['平手', '平手/半球', '半球/一球升', '受一球/球半降', 'xx', '99', '-0.75', ''][event_id % 8 + 1] AS raw, ['2', '2/2.5', '2.5/3', '1/3', 'x', '21'][event_id % 6 + 1] AS tot FROM events)
SELECT event_id, [0, -0.25, -0.75, 1.25, NULL, NULL, -0.75, NULL][event_id % 8 + 1]::DOUBLE AS line, [NULL, NULL, 'up', 'down', NULL, NULL, NULL, NULL][event_id % 8 + 1] AS movement, [NULL, NULL, NULL, NULL, 'unknown_handicap_line', 'handicap_line_out_of_range', NULL, 'missing'][event_id % 8 + 1] AS error,
  [2, 2.25, 2.75, NULL, NULL, NULL][event_id % 6 + 1]::DOUBLE AS total, [NULL, NULL, NULL, 'invalid_total_split', 'unknown_total_line', 'total_line_out_of_range'][event_id % 6 + 1] AS total_error FROM t""")
def parsed_lines(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    h = parse.handicap_line(pick(["平手", "平手/半球", "半球/一球升", "受一球/球半降", "xx", "99", "-0.75", ""]))
    t = parse.total_line(pick(["2", "2/2.5", "2.5/3", "1/3", "x", "21"]))
    return _read(spark, d, "events").select("event_id", h["line"].alias("line"), h["movement"].alias("movement"), h["error"].alias("error"), t["line"].alias("total"), t["error"].alias("total_error"))


@_query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1234.5 WHEN 1 THEN 0.125 END::DOUBLE AS value, event_id % 4 = 2 AS bad, ['unknown', 'summary', 'official', 'bookmaker'][event_id % 4 + 1] AS role, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def parsed_scalars(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    v = parse.decimal_text(pick(["1,234.5", "0.125", "abc", ""]))
    return _read(spark, d, "events").select("event_id", v["value"].cast("double").alias("value"), v["bad"].alias("bad"), parse.source_role(pick([" ", "平均值", "竞彩官方", "x"])).alias("role"), parse.local_day("ts").cast("string").alias("local_day"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@_query("""WITH v AS (SELECT o_orderkey, unnest(list_filter([CASE WHEN NOT (o_orderstatus IN ('F', 'O')) THEN 'status' END, CASE WHEN NOT (o_totalprice > 1000) THEN 'price' END, CASE WHEN NOT (o_orderdate < TIMESTAMP '1998-01-01') THEN 'date' END], lambda x: x IS NOT NULL)) AS code FROM orders) SELECT code, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM v GROUP BY code""")
def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    e = {"status": contracts.one_of("o_orderstatus", "F", "O"), "price": F.col("o_totalprice") > 1000, "date": F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")}
    return contracts.violations(_read(spark, d, "orders"), e, "o_orderkey").groupBy("code").agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"))


@_query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return contracts.duplicates(_read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("""SELECT o_orderkey::VARCHAR AS id FROM orders o WHERE o_orderstatus <> 'P' AND NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND json_extract_string(e.props, '$.k')::BIGINT = o.o_orderkey)""")
def eligible_fixtures(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), (F.col("o_orderstatus") != "P").alias("result_eligible"), F.lit("regular_time_90").alias("result_scope"))
    e = _read(spark, d, "events").select(F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"), F.to_json(F.struct(F.get_json_object("props", "$.k").alias("fixture_record_id"))).alias("details"))
    return contracts.eligible_fixtures(o, e, "id").select("id")
