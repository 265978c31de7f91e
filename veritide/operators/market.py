"""Consensus of quoted prices and the features built on it.

Frames have one row for each (keys, bookmaker). A group is one fixture's bookmakers, tens of rows by
nature, so it is gathered once as an array, and all medians come from that array: one shuffle by the
keys, no window and no self join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.functions.odds import SIDES, devig, devig_pair, favourite, favourite_line, favourite_side, gap
from veritide.functions.parse import bookmaker_name
from veritide.operators.staged import staged

#: So many names are broadcast at most.
SMALL = 200_000
#: Summary rows among bookmakers.
SUMMARY = ("Avg", "Max", "Min", "Average", "Highest", "Lowest")


def _normal(parts: list[Column]) -> Column:
    total = parts[0] + parts[1] + parts[2]
    return F.when(total > 0, F.array(*(x / F.nullif(total, F.lit(0.0)) for x in parts)))


def quotes(df: DataFrame, keys: list[str], bookmaker: str, prices: tuple[str, str, str], rule: str = "positive", record: str | None = None) -> DataFrame:
    """keys, bookmaker, p, margin: de-vigged rows of real bookmakers; of repeats the one with the greatest record stays."""
    rows = df.where(~F.col(bookmaker).cast("string").isin(*SUMMARY)).withColumn("_d", devig(*prices, rule=rule)).where("_d is not null")
    if record:
        best = rows.groupBy(*keys, bookmaker).agg(F.max_by("_d", record).alias("_d"))
        return best.select(*keys, bookmaker, "_d.p", "_d.margin")
    return rows.select(*keys, bookmaker, "_d.p", "_d.margin")


def panel(quoted: DataFrame, keys: list[str], bookmaker: str) -> DataFrame:
    """keys and _q: each group's bookmakers as an array of structs (b, p)."""
    return quoted.groupBy(*keys).agg(F.collect_list(F.struct(F.col(bookmaker).alias("b"), F.col("p").alias("p"))).alias("_q"))


def median_of(values: Column) -> Column:
    """Exact median of an array that is sorted already; null if it is empty."""
    n = F.size(values)
    return (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2


def _sorted(values: Column) -> Column:
    return F.sort_array(values)


def _component(i: int) -> Column:
    return F.transform("_q", lambda x: x["p"][i])


def consensus(quoted: DataFrame, keys: list[str], bookmaker: str, least: int = 3) -> DataFrame:
    """keys, bookmakers, p, gap, dispersion: component medians, normalised; the greatest MAD about the raw medians."""
    return _agreed(panel(quoted, keys, bookmaker), least).select(*keys, "bookmakers", "p", "gap", "dispersion")


def _agreed(groups: DataFrame, least: int) -> DataFrame:
    """Adds bookmakers, p, gap, dispersion to the groups of panel() that have them."""
    out = groups.withColumn("bookmakers", F.size(F.array_distinct(F.transform("_q", lambda x: x["b"]))).cast("long")).where(F.col("bookmakers") >= least)
    out = out.withColumns({f"_s{i}": _sorted(_component(i)) for i in range(3)}).withColumns({f"_m{i}": median_of(F.col(f"_s{i}")) for i in range(3)})
    out = out.withColumns({f"_a{i}": _sorted(F.transform(f"_s{i}", lambda x: F.abs(x - F.col(f"_m{i}")))) for i in range(3)})  # noqa: B023
    out = out.withColumns({"p": _normal([F.col(f"_m{i}") for i in range(3)]), "dispersion": F.greatest(*(median_of(F.col(f"_a{i}")) for i in range(3)))})
    return out.where("p is not null").withColumn("gap", gap("p")).drop(*(f"_{c}{i}" for c in "sma" for i in range(3)))


def average_consensus(quoted: DataFrame, keys: list[str], bookmaker: str, preferred: str = "Avg", excluded: tuple[str, ...] = ("Max", "Min")) -> DataFrame:
    """keys, p, bookmakers: the preferred row where there is one, else the mean over the others."""
    has = F.max((F.col(bookmaker) == preferred).cast("int")).over(Window.partitionBy(*keys)) == 1
    used = quoted.where(~F.col(bookmaker).isin(*excluded)).withColumn("_has", has).where(~F.col("_has") | (F.col(bookmaker) == preferred))
    return used.groupBy(*keys).agg(F.count("*").alias("bookmakers"), *(F.avg(F.col("p")[i]).alias(f"p{i}") for i in range(3))).select(*keys, "bookmakers", _normal([F.col(f"p{i}") for i in range(3)]).alias("p"))


def anomalies(quoted: DataFrame, agreed: DataFrame, keys: list[str], bookmaker: str, least: int = 5, floor: float = 0.03, limit: float = 3.5) -> DataFrame:
    """keys, bookmaker, deviation, robust_z, max_deviation, anomaly: 0.6745 * deviation / MAD about 0; with a zero MAD the absolute floor decides."""
    groups = panel(quoted, keys, bookmaker).join(agreed.select(*keys, F.col("p").alias("_c")), keys)
    devs = F.transform("_q", lambda x: F.struct(x["b"].alias("b"), F.zip_with(x["p"], F.col("_c"), lambda a, b: a - b).alias("dev")))
    groups = groups.withColumn("_n", F.size("_q")).withColumn("_q", devs)
    groups = groups.withColumns({f"_mad{i}": median_of(_sorted(F.transform("_q", lambda x: F.abs(x["dev"][i])))) for i in range(3)})  # noqa: B023
    rows = groups.select(*keys, "_n", *(f"_mad{i}" for i in range(3)), F.explode("_q").alias("_x")).select(*keys, "_n", *(f"_mad{i}" for i in range(3)), F.col("_x.b").alias(bookmaker), F.col("_x.dev").alias("dev"))
    z = F.array(*(F.when(F.col(f"_mad{i}") > 0, 0.6745 * F.col("dev")[i] / F.nullif(F.col(f"_mad{i}"), F.lit(0.0))) for i in range(3)))
    most = F.greatest(*(F.abs(F.col("dev")[i]) for i in range(3)))
    outlier = F.exists(z, lambda x: F.coalesce(F.abs(x) >= limit, F.lit(False)))
    zero = F.lit(False)
    for i in range(3):
        zero = zero | ((F.col(f"_mad{i}") == 0) & (F.abs(F.col("dev")[i]) >= floor))
    return rows.select(*keys, bookmaker, F.col("dev").alias("deviation"), z.alias("robust_z"), most.alias("max_deviation"), ((F.col("_n") >= least) & (most >= floor) & (outlier | zero)).alias("anomaly"))


def peer_dispersion(quoted: DataFrame, agreed: DataFrame, keys: list[str], bookmaker: str = "book") -> DataFrame:
    """keys, dispersion: the median over bookmakers of their greatest distance from the normalised consensus."""
    groups = panel(quoted, keys, bookmaker).join(agreed.select(*keys, F.col("p").alias("_c")), keys)
    far = F.transform("_q", lambda x: F.array_max(F.zip_with(x["p"], F.col("_c"), lambda a, b: F.abs(a - b))))
    return groups.withColumn("_far", _sorted(far)).select(*keys, median_of(F.col("_far")).alias("dispersion"))


def leave_one_out(quoted: DataFrame, agreed: DataFrame, keys: list[str], bookmaker: str) -> DataFrame:
    """keys, direction_flip, max_shift: the consensus without each bookmaker. Groups of one bookmaker have none."""
    groups = panel(quoted, keys, bookmaker).join(agreed.select(*keys, "p"), keys)
    groups = groups.select(*keys, "p", F.size("_q").alias("_n"), *(_sorted(_component(i)).alias(f"_s{i}") for i in range(3)), F.posexplode("_q").alias("_i", "_x"))

    def without(i: int) -> Column:
        """Median of the sorted values less one of the bookmaker's own value: values at and after its place move down by one."""
        s, at = F.col(f"_s{i}"), F.array_position(f"_s{i}", F.col("_x.p")[i]) - 1
        pick = lambda k: F.get(s, F.when(k >= at, k + 1).otherwise(k).cast("int"))
        return (pick(F.floor((F.col("_n") - 2) / 2)) + pick(F.floor((F.col("_n") - 1) / 2))) / 2

    rest = groups.where("_n > 1").select(*keys, "p", *(without(i).alias(f"_m{i}") for i in range(3))).withColumn("_r", _normal([F.col(f"_m{i}") for i in range(3)]))
    return rest.groupBy(*keys).agg(F.max(favourite("_r") != favourite("p")).alias("direction_flip"), F.max(F.array_max(F.zip_with("_r", "p", lambda x, y: F.abs(x - y)))).alias("max_shift"))


def movement(pairs: DataFrame, keys: list[str], agreed: DataFrame, drop: float = 0.015, strengthen: float = 0.010, alternative: float = 0.0075) -> DataFrame:
    """Opening-to-current moves of the favourite and support ratios. pairs: keys, opening and current structs of prices (home, draw, away).

    Medians default to 0 and ratios to 0 where nothing counts, as does a favourite that is the draw.
    """
    rows = pairs.join(agreed.select(*keys, favourite("p").alias("_f")), keys).where("_f != 1")
    o, c = devig("opening.home", "opening.draw", "opening.away")["p"], devig("current.home", "current.draw", "current.away")["p"]
    rows = rows.withColumn("_o", o).withColumn("_c", c).withColumn("_d", F.when(F.col("_o").isNotNull() & F.col("_c").isNotNull(), F.zip_with("_c", "_o", lambda x, y: x - y)))
    fav, opp = F.get("_d", F.col("_f")), F.get("_d", 2 - F.col("_f"))
    odds = F.when(F.col("_f") == 0, F.col("current.home") - F.col("opening.home")).otherwise(F.col("current.away") - F.col("opening.away"))
    ratio = lambda cond: F.coalesce(F.round(F.avg(F.when(F.col("_d").isNotNull(), cond.cast("int"))), 12), F.lit(0.0))
    r12 = lambda x: F.round(x, 12)  # noqa: E731  thresholds are decimal
    return rows.groupBy(*keys).agg(
        F.count("_d").alias("paired"),
        F.coalesce(r12(F.median(fav)), F.lit(0.0)).alias("delta_p_favourite"),
        F.coalesce(r12(F.median(odds)), F.lit(0.0)).alias("delta_favourite_odds"),
        ratio(r12(fav) <= -drop).alias("cooling_support"),
        ratio(r12(fav) >= strengthen).alias("strengthening_support"),
        ratio((r12(F.col("_d")[1]) >= alternative) | (r12(opp) >= alternative)).alias("alternative_support"),
    )


def line_movement(lines: DataFrame, keys: list[str], agreed: DataFrame, material: float = 0.25) -> DataFrame:
    """Favourite-side handicap line, its move, and the shares that retreat or do not strengthen. lines: keys, opening_line, current_line."""
    rows = lines.join(agreed.select(*keys, favourite_side("p").alias("_side")), keys).where("_side != 'draw' and opening_line is not null and current_line is not null")
    now, move = favourite_line("current_line", "_side"), favourite_line("current_line", "_side") - favourite_line("opening_line", "_side")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("paired_lines"), F.median(now).alias("favourite_line"), F.median(move).alias("delta_line"), F.avg((move <= -material).cast("int")).alias("retreat_support"), F.avg((move <= 0).cast("int")).alias("not_strengthening")
    )


def one_row(rows: DataFrame, keys: list[str], bookmaker: str, fields: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with each bookmaker once, contradictions): of equal rows of a bookmaker the first by order stays; one whose rows differ in the fields has none."""
    sign = F.struct(*(F.coalesce(F.col(f).cast("string"), F.lit("None")).alias(f) for f in fields))
    whole = F.struct(*(c for c in rows.columns if c not in {*keys, bookmaker}))
    each = rows.groupBy(*keys, bookmaker).agg(F.min(sign).alias("_a"), F.max(sign).alias("_z"), F.min_by(whole, F.struct(*order)).alias("_row"))
    return each.where("_a = _z").select(*keys, bookmaker, "_row.*"), each.where("_a != _z").select(*keys, bookmaker)


def cover_conflict(index: DataFrame, keys: list[str], agreed: DataFrame, margin: float = 0.10, bookmaker: str | None = None, order: list[str] | None = None) -> DataFrame:
    """How many handicap-index rows speak against the favourite covering. index: keys, line, home, draw, away probabilities.

    With a bookmaker, repeats are dropped first, and bookmakers that contradict themselves, as one_row() does.
    """
    if bookmaker:
        index = one_row(index, keys, bookmaker, ["line", "home", "draw", "away"], order or ["line"])[0]
    rows = index.join(agreed.select(*keys, favourite("p").alias("_f")), keys).where("_f != 1")
    total = F.col("home") + F.col("draw") + F.col("away")
    bad = F.col("line").isNull() | total.isNull() | (F.least("home", "draw", "away") < 0)
    wrong = F.when(F.col("_f") == 0, F.col("line") >= 0).otherwise(F.col("line") <= 0)
    kind = F.when(bad, "invalid").when(F.col("line") == 0, "zero_line").when(wrong, "direction_mismatch").when(total <= 0, "invalid").otherwise("valid")
    cover = F.when(F.col("_f") == 0, F.col("home")).otherwise(F.col("away")) / F.nullif(total, F.lit(0.0))
    rows = rows.withColumn("_kind", kind).withColumn("_v", F.round(1 - 2 * cover, 12))
    return rows.groupBy(*keys).agg(
        *(F.count_if(F.col("_kind") == k).alias(f"{k}_count") for k in ("valid", "zero_line", "direction_mismatch", "invalid")), F.coalesce(F.avg(F.when(F.col("_kind") == "valid", (F.col("_v") >= margin).cast("int"))), F.lit(0.0)).alias("conflict_support")
    )


def pair_markets(euro: DataFrame, asian: DataFrame, total: DataFrame, keys: list[str]) -> DataFrame:
    """The same bookmaker across three markets, kept from the first."""
    return euro.join(asian, keys, "left").join(total, keys, "left")


def signals(paired: DataFrame, direction: str, move: float = 0.015, line_move: float = 0.25) -> DataFrame:
    """euro_signal, asian_signal, total_signal and internal_conflict of each bookmaker.

    paired: delta (array of probability moves), direction (home, draw, away), opening and current
    asian_line, asian_home, asian_away, and total_line, prefixed opening_ and current_.
    """
    d = F.round(F.element_at("delta", F.array_position(F.array(*map(F.lit, SIDES)), F.col(direction)).cast("int")), 12)
    euro = F.when(d >= move, "support").when(d <= -move, "oppose").otherwise("unchanged")
    side = F.col(direction)
    line = favourite_line("current_asian_line", side) - favourite_line("opening_asian_line", side)
    own = F.when(side == "home", 0).otherwise(1)
    price = F.round(F.get(devig_pair("current_asian_home", "current_asian_away"), own) - F.get(devig_pair("opening_asian_home", "opening_asian_away"), own), 12)
    flat = F.abs(line) < 1e-12
    asian = (
        F.when(line.isNull() | (side == "draw"), "not_evaluable")
        .when((line >= line_move) | (flat & F.coalesce(price >= move, F.lit(False))), "confirm")
        .when((line <= -line_move) | (flat & F.coalesce(price <= -move, F.lit(False))), "conflict")
        .otherwise("flat")
    )
    total = F.when(F.col("current_total_line").isNull(), "not_available").when(F.abs(F.col("current_total_line") - F.col("opening_total_line")) >= line_move, "material").otherwise("flat")
    out = paired.withColumns({"euro_signal": euro, "asian_signal": asian, "total_signal": total})
    return out.withColumn("internal_conflict", ((F.col("euro_signal") == "support") & (F.col("asian_signal") == "conflict")) | ((F.col("euro_signal") == "oppose") & (F.col("asian_signal") == "confirm")))


def bookmaker_keys(rows: DataFrame, fixture: list[str], name: str, ident: str) -> tuple[DataFrame, DataFrame]:
    """(rows with bookmaker_key, warnings): who a row is from, over all markets of a fixture.

    A name with several ids, and an id with several names, are contradictions: they exclude all rows of such names, those with a name
    alone too. Other rows have their own id, or the one id that their name has elsewhere, or else their name. Rows with neither are left out.
    """
    spelt = staged(rows.select(F.col(name).alias("_spelt")).distinct().withColumn("_name", F.nullif(F.coalesce(bookmaker_name("_spelt"), F.lit("")), F.lit(""))))  # a Python function over rows would undo how they are dealt
    spelt = F.broadcast(spelt) if spelt.count() <= SMALL else spelt
    named = rows.join(spelt, F.col(name) == F.col("_spelt"), "left").drop("_spelt").withColumn("_ident", F.nullif(F.coalesce(F.trim(F.col(ident).cast("string")), F.lit("")), F.lit("")))
    pairs = named.where("_name is not null and _ident is not null").select(*fixture, "_name", "_ident").distinct()
    over = lambda by: Window.partitionBy(*fixture, by)  # noqa: E731  a fixture's bookmakers are few by nature
    counted = pairs.withColumns({"_ids": F.count("*").over(over("_name")), "_names": F.count("*").over(over("_ident"))})
    warned = counted.select(*fixture, F.explode(F.array_compact(F.array(
        F.when(F.col("_ids") > 1, F.concat(F.lit("bookmaker_name_maps_multiple_ids:"), "_name")), F.when(F.col("_names") > 1, F.concat(F.lit("bookmaker_id_maps_multiple_names:"), "_ident")),
    ))).alias("warning")).distinct()
    several = lambda c, by: F.coalesce(F.min(c).over(over(by)) != F.max(c).over(over(by)), F.lit(False))
    has_name, has_id = F.col("_name").isNotNull(), F.col("_ident").isNotNull()
    # windows and no joins, as these shuffle rows that are dealt by the fixture alone
    marked = named.withColumn("_id_out", has_id & several("_name", "_ident")).withColumns({"_out": has_name & (several("_ident", "_name") | F.max("_id_out").over(over("_name"))), "_known": F.when(has_name, F.min("_ident").over(over("_name")))})
    fine_id = has_id & ~F.col("_id_out")
    key = F.when(fine_id, F.concat(F.lit("id:"), "_ident")).when(F.col("_known").isNotNull(), F.concat(F.lit("id:"), "_known")).when(F.col("_name").isNotNull(), F.concat(F.lit("name:"), "_name"))
    kept = marked.withColumn("bookmaker_key", key).where(~F.col("_out") & F.col("bookmaker_key").isNotNull())
    return kept.select(*rows.columns, "bookmaker_key"), warned


def stride_rows(cells: DataFrame, sheet: list[str], index: str, eligible: Column) -> DataFrame:
    """Rows whose next row holds their opening prices: in each run of consecutive eligible rows the 1st, 3rd, 5th... with `opening` from the row after."""
    w = Window.partitionBy(*sheet).orderBy(index)
    marked = cells.withColumn("_ok", eligible).withColumn("opening", F.lead("cells").over(w)).where("_ok")
    runs = marked.withColumn("_run", F.col(index) - F.row_number().over(w))
    at = F.row_number().over(Window.partitionBy(*sheet, "_run").orderBy(index))
    return runs.withColumn("_at", at).where("_at % 2 = 1").drop("_ok", "_run", "_at")


def cells_to_rows(cells: DataFrame, market: str = "market") -> DataFrame:
    """Typed rows from cells: two-way markets need 9 cells with prices at 1 and 3 (line between), an index row 12 cells."""
    from veritide.functions.parse import decimal_text, handicap_line, source_role, total_line

    at = lambda i: F.get("cells", F.lit(i))
    dec = lambda i, percent=False: decimal_text(at(i), percent)["value"]
    line = lambda i: F.when(F.col(market) == "daxiao", total_line(at(i))["line"]).otherwise(handicap_line(at(i))["line"])
    two = F.when(
        (F.col(market) != "rangqiu") & (F.size("cells") >= 9) & dec(1).isNotNull() & dec(3).isNotNull(),
        F.struct(dec(1).alias("current_first"), line(2).alias("current_line"), dec(3).alias("current_second"), dec(5).alias("opening_first"), line(6).alias("opening_line"), dec(7).alias("opening_second")),
    )
    index = F.when(
        (F.col(market) == "rangqiu") & (F.size("cells") >= 12),
        F.struct(dec(1).alias("line"), *(dec(2 + i).alias(f"{s}_index") for i, s in enumerate(SIDES)), *(dec(5 + i, True).alias(f"{s}_probability") for i, s in enumerate(SIDES)), dec(8, True).alias("return_rate"), *(dec(9 + i).alias(f"{s}_kelly") for i, s in enumerate(SIDES))),
    )
    return cells.select("*", F.trim(at(0)).alias("bookmaker"), source_role(at(0)).alias("row_role"), two.alias("two_way"), index.alias("handicap_index"))


def wide_to_long(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cohort, market, bookmaker, line, prices): odds columns found by their headers; all prices above 1.

    Opening 1X2 <P>H/D/A, closing <P>CH/CD/CA; totals <P>>2.5 and <P><2.5, closing with C; handicap <P>AHH/AHA with AHh, closing <P>CAHH/CAHA with AHCh.
    """
    have = set(df.columns)
    found: list[Column] = []

    def add(cohort: str, market: str, prefix: str, names: list[str], line: Column) -> None:
        if all(n in have for n in names):
            found.append(F.struct(F.lit(cohort).alias("cohort"), F.lit(market).alias("market"), F.lit(prefix).alias("bookmaker"), line.alias("line"), F.array(*(F.col(f"`{n}`").try_cast("double") for n in names)).alias("prices")))

    none, half = F.lit(None).cast("double"), F.lit(2.5)
    for name in sorted(have):
        if name.endswith("CH") and not name.endswith("AHCH") and len(name) > 2:
            add("closing", "1x2", name[:-2], [name, f"{name[:-2]}CD", f"{name[:-2]}CA"], none)
        elif name.endswith("H") and not name.endswith(("AHH", "CH")) and len(name) > 1 and name not in ("AH",):
            add("opening", "1x2", name[:-1], [name, f"{name[:-1]}D", f"{name[:-1]}A"], none)
        if name.endswith("C>2.5"):
            add("closing", "total", name[:-5], [name, f"{name[:-5]}C<2.5"], half)
        elif name.endswith(">2.5"):
            add("opening", "total", name[:-4], [name, f"{name[:-4]}<2.5"], half)
        if name.endswith("CAHH") and "AHCh" in have:
            add("closing", "asian_handicap", name[:-4], [name, f"{name[:-4]}CAHA"], F.col("AHCh").try_cast("double"))
        elif name.endswith("AHH") and "AHh" in have:
            add("opening", "asian_handicap", name[:-3], [name, f"{name[:-3]}AHA"], F.col("AHh").try_cast("double"))
    if not found:
        raise ValueError("no odds columns")
    long = df.select(*keys, F.explode(F.array(*found)).alias("q")).select(*keys, "q.*")
    return long.where(F.forall("prices", lambda x: F.coalesce(x > 1, F.lit(False))) & ((F.col("market") != "asian_handicap") | F.col("line").isNotNull()))


def parity(old: DataFrame, new: DataFrame, snapshot: str, signature: list[str]) -> DataFrame:
    """(snapshot, ok): whether every old row is among the new ones as often, as multisets."""
    count = lambda df, name: df.groupBy(snapshot, F.struct(*signature).alias("_s")).agg(F.count("*").alias(name))
    a, b = count(old, "_old"), count(new, "_new")
    on = [a[snapshot].eqNullSafe(b[snapshot]), a["_s"].eqNullSafe(b["_s"])]
    return a.join(b, on, "left").groupBy(a[snapshot]).agg(F.bool_and(F.coalesce("_new", F.lit(0)) >= F.col("_old")).alias("ok"))
