"""Stream-shaped operators: each runs on a stream of closed files and, with equal results, on a table."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues


def claim_once(events: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """Each id once within the watermark; on a table each id once, the earliest."""
    if events.isStreaming:
        return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
    rest = F.struct(*(c for c in events.columns if c != key))
    return events.groupBy(key).agg(F.min_by(rest, F.struct(at, F.xxhash64(*(c for c in events.columns if c != key)))).alias("_r")).select(key, "_r.*")


def _path(spark: SparkSession, name: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(name)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def append_new(target: str, key: str, at: str | None = None, buckets: int = 16, name: str = "stream") -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that appends rows whose id the target lacks, and nothing when a batch is replayed.

    The target has a folder for each day of `at` (all rows are of one without it), in it one for each bucket of ids, in it one for each epoch of the stream
    called name. An id counts as known if it is on the same day or a day beside it: repeats come within a day at most, as after claim_once. Only these days are
    listed, and of these only the buckets of the batch are read, so the work of a batch does not grow with the target. An epoch is written into folders of its own, replacing what an
    attempt that failed left there, and is done once its mark stands below _epochs; a replay of a done one is skipped.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark, fs = _path(spark, f"{target}/_epochs/{name}-{epoch}")
        if fs.exists(mark):
            return
        day = F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("none")) if at else F.lit("all")
        own = f"{name}-{epoch}"
        new = batch.dropDuplicates([key]).withColumns({"day": day, "bucket": F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"), "epoch": F.lit(own)}).persist()
        try:
            held = new.select("day", "bucket").distinct().collect()  # days of a batch x buckets
            if held:
                days = {r["day"] for r in held}
                beside = {str(date.fromisoformat(d) + timedelta(days=n)) for d in days if at and d != "none" for n in (-1, 0, 1)} | days
                paths = [f"{target}/day={d}" for d in sorted(beside) if fs.exists(_path(spark, f"{target}/day={d}")[0])]
                fresh = new
                if paths:
                    there = spark.read.option("basePath", target).schema(new.schema).parquet(*paths)
                    known = there.where(F.col("bucket").isin({r["bucket"] for r in held}) & (F.col("epoch") != own)).select(key)
                    fresh = new.join(known, key, "left_anti")
                fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "bucket", "epoch").parquet(target)
        finally:
            new.unpersist()
        fs.create(mark, True).close()

    return run


def appended_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of epochs that are done."""
    rows = spark.read.parquet(target)
    marks, fs = _path(spark, f"{target}/_epochs")
    done = [f.getPath().getName() for f in fs.listStatus(marks)] if fs.exists(marks) else []
    marked = spark.createDataFrame([(m,) for m in done], "epoch string")
    return rows.join(marked, "epoch", "left_semi").drop("day", "bucket", "epoch")


STATUSES = ("new", "unchanged", "metadata_changed", "kickoff_changed", "identity_conflict")


def identity_states(observed: DataFrame, key: str, at: str, record: str, team: str, kickoff: str, metadata: list[str]) -> DataFrame:
    """status of each identity observation against the one before; a changed team is a conflict that stays. Batch form."""
    w = Window.partitionBy(key).orderBy(at, record)
    before = F.lag(F.struct(team, kickoff, *metadata)).over(w)
    changed = F.coalesce((before[team] != F.col(team)).cast("int"), F.lit(0))
    marked = observed.withColumn("_b", before).withColumn("_c", changed)
    conflict = F.max("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    differs = ~F.struct(*(F.col(f"_b.{m}").alias(m) for m in metadata)).eqNullSafe(F.struct(*metadata)) if metadata else F.lit(False)
    status = F.when(conflict, "identity_conflict").when(F.col("_b").isNull(), "new").when(~F.col(f"_b.{kickoff}").eqNullSafe(F.col(kickoff)), "kickoff_changed").when(differs, "metadata_changed").otherwise("unchanged")
    return marked.withColumn("status", status).drop("_b", "_c")


def identity_stream(observed: DataFrame, delay: str, keep: str = "7 days") -> DataFrame:
    """Stream form over fixture_id, observed_at, record_id, team, kickoff_at, label: emits fixture_id, record_id, status; state ends `keep` after the last event."""
    days = int(keep.split()[0])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        team, kickoff, label, conflict = state.get if state.exists else (None, None, None, None)
        rows = pd.concat(list(batches)).sort_values(["observed_at", "record_id"])
        out, last = [], 0
        for r in rows.itertuples():
            at = r.kickoff_at.value // 1000
            if conflict is None:
                status, conflict = "new", False
            elif conflict or r.team != team:
                status, conflict = "identity_conflict", True
            else:
                status = "kickoff_changed" if at != kickoff else "metadata_changed" if r.label != label else "unchanged"
            team, kickoff, label = r.team, at, r.label
            out.append((key[0], r.record_id, status))
            last = max(last, int(r.observed_at.value // 1_000_000))
        state.update((team, kickoff, label, conflict))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + days * 86_400_000 + 1)
        yield pd.DataFrame(out, columns=["fixture_id", "record_id", "status"])

    grouped = observed.withWatermark("observed_at", delay).groupBy("fixture_id")
    return grouped.applyInPandasWithState(step, "fixture_id string, record_id string, status string", "team string, kickoff long, label string, conflict boolean", "append", GroupStateTimeout.EventTimeTimeout)


#: Result checks after kickoff, in hours, then in days.
CHECK_HOURS, CHECK_DAYS = (3, 6, 24), (2, 3, 4, 5, 6, 7)


def plan(identities: DataFrame, named: DataFrame, seen: str, kickoff: str) -> DataFrame:
    """Cutoffs of each identity version: pending, or missed_before_discovery where the window had closed when it was seen."""
    from veritide.operators.asof import cutoffs

    due = cutoffs(identities, named, kickoff)
    return due.withColumn("status", F.when(F.col("cutoff") < F.col(seen), "missed_before_discovery").otherwise("pending"))


PLANNED = "fixture_id string, record_id string, target string, cutoff timestamp, status string, at timestamp"


def plan_events(identities: DataFrame, named: DataFrame, upto: Column) -> DataFrame:
    """What happens to the plan of each fixture until `upto`: rows of PLANNED. Batch form.

    identities: fixture_id, observed_at, record_id, kickoff_at. The first of them, and each that moves the kickoff, makes a plan: its targets are pending, or
    missed_before_discovery where their cutoff had passed. A pending one is superseded by the next plan if that is seen by its cutoff, else it expires there.
    named: target, minutes (as asof.targets has them).
    """
    by = Window.partitionBy("fixture_id").orderBy("observed_at", "record_id")
    moved = identities.withColumn("_before", F.lag("kickoff_at").over(by)).where("_before is null or kickoff_at != _before")
    version = moved.withColumn("_next", F.lead("observed_at").over(by)).where(F.col("observed_at") <= upto)
    minutes = {r["target"]: r["minutes"] for r in named.collect()}  # eight names at most
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("target"), (F.col("kickoff_at") - F.expr(f"INTERVAL {m} MINUTES")).alias("cutoff")) for n, m in minutes.items()))).alias("_t")
    planned = version.select("fixture_id", "record_id", "observed_at", "_next", each).select("*", "_t.*")
    missed, moved_by = F.col("cutoff") < F.col("observed_at"), F.coalesce((F.col("_next") <= F.col("cutoff")), F.lit(False))
    first = F.struct(F.when(missed, "missed_before_discovery").otherwise("pending").alias("status"), F.col("observed_at").alias("at"))
    last = F.when(~missed & moved_by & (F.col("_next") <= upto), F.struct(F.lit("superseded").alias("status"), F.col("_next").alias("at"))).when(~missed & ~moved_by & (F.col("cutoff") <= upto), F.struct(F.lit("expired").alias("status"), F.col("cutoff").alias("at")))
    return planned.select("fixture_id", "record_id", "target", "cutoff", F.explode(F.array_compact(F.array(first, last))).alias("_e")).select("fixture_id", "record_id", "target", "cutoff", "_e.*")


class PlanKeeper(StatefulProcessor):
    """Keeps each fixture's plan as state. Observations wait until the watermark has passed them, so they take effect in order of their time, as cutoffs do; both are timers."""

    def __init__(self, minutes: dict[str, int]):
        self.minutes = minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.plan = handle.getValueState("plan", "held string")

    def _held(self) -> dict:
        return json.loads(self.plan.get()[0]) if self.plan.exists() else {"waiting": [], "kickoff": None, "open": []}

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        for batch in rows:
            for r in batch.itertuples():
                seen = r.observed_at.value // 1000
                held["waiting"].append([seen, r.record_id, r.kickoff_at.value // 1000])
                self._wake(seen)
        self.plan.update((json.dumps(held),))
        yield self._rows(key, [])

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, held, out = expiredTimerInfo.getExpiryTimeInMs() * 1000, self._held(), []
        # an observation at a cutoff comes before it
        due = sorted([(w[0], 0, w) for w in held["waiting"] if w[0] <= now] + [(o[0], 1, o) for o in held["open"] if o[0] <= now])
        while due:
            at, kind, what = due.pop(0)
            if kind == 1:
                if what in held["open"]:
                    held["open"].remove(what)
                    out.append((what[1], what[2], at, "expired", at))
                continue
            held["waiting"].remove(what)
            _, record, kickoff = what
            if kickoff == held["kickoff"]:
                continue
            out += [(o[1], o[2], o[0], "superseded", at) for o in held["open"]]
            held["kickoff"], held["open"] = kickoff, []
            for target, minutes in self.minutes.items():
                cutoff = kickoff - minutes * 60_000_000
                out.append((record, target, cutoff, "missed_before_discovery" if cutoff < at else "pending", at))
                if cutoff >= at:
                    held["open"].append([cutoff, record, target])
                    if cutoff <= now:
                        due = sorted([*due, (cutoff, 1, [cutoff, record, target])])
                    else:
                        self._wake(cutoff)
        self.plan.update((json.dumps(held),))
        yield self._rows(key, out)

    def _rows(self, key: Any, out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame([(key[0], *r) for r in out], columns=["fixture_id", "record_id", "target", "cutoff", "status", "at"])
        return frame.assign(**{c: pd.to_datetime(frame[c], unit="us") for c in ("cutoff", "at")})

    def close(self) -> None:
        pass


def plan_stream(identities: DataFrame, minutes: dict[str, int], delay: str) -> DataFrame:
    """Stream form of plan_events: a row when something happens to a plan. Needs a state store with timers (spark.sql.streaming.stateStore.providerClass of RocksDB).

    Rows later than `delay` after the latest are dropped by the watermark. A plan stays in the state: its fixture can move at any time.
    """
    rows = identities.select("fixture_id", "observed_at", "record_id", "kickoff_at").withWatermark("observed_at", delay)
    return rows.groupBy("fixture_id").transformWithStateInPandas(PlanKeeper(minutes), PLANNED, "append", "eventTime")


def result_checks(fixtures: DataFrame, kickoff: str, now: Column) -> DataFrame:
    """Checks at T+3/6/24 hours and R+2..7 days: expired, due or pending."""
    steps = [(f"T+{h}h", h) for h in CHECK_HOURS] + [(f"R+{d}d", 24 * d) for d in CHECK_DAYS]
    at = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), (F.col(kickoff) + F.expr(f"INTERVAL {h} HOURS")).alias("at")) for n, h in steps)))
    rows = fixtures.select("*", at.alias("_c")).select("*", "_c.name", "_c.at").drop("_c")
    last = F.col(kickoff) + F.expr(f"INTERVAL {24 * CHECK_DAYS[-1]} HOURS")
    return rows.withColumn("status", F.when(now > last, "expired").when(now >= F.col("at"), "due").otherwise("pending"))


def superseded(planned: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Marks plans of all but the last identity version of a key."""
    newest = F.max(version).over(Window.partitionBy(*keys))
    return planned.withColumn("superseded", F.col(version) < newest)


def lateness(rows: DataFrame, observed: str, start: str, end: str, now: Column | None = None) -> DataFrame:
    """in_window, early, late by the window; with now also late_for_cutoff where nothing came in time."""
    s = F.when(F.col(observed).between(F.col(start), F.col(end)), "in_window").when(F.col(observed) < F.col(start), "early").when(F.col(observed) > F.col(end), "late")
    if now is not None:
        s = F.coalesce(s, F.when(F.col(end) < now, "late_for_cutoff").otherwise("pending"))
    return rows.withColumn("lateness", s)


def daily_counts(events: DataFrame, at: str, keys: list[str], delay: str = "1 day", offset: str = "16 hours") -> DataFrame:
    """Events by local day (windows start at the offset from midnight UTC: 16 hours for UTC+8) and keys."""
    rows = events.withWatermark(at, delay) if events.isStreaming else events
    g = rows.groupBy(F.window(at, "1 day", "1 day", offset), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("day_start"), *keys, "n")


def invalidated(events: DataFrame, key: str, kind: str = "fixture_excluded") -> DataFrame:
    """Keys that any event excludes; naming one twice changes nothing."""
    return events.where(F.col("event_type") == kind).select(key).distinct()


def publish_once(candidates: DataFrame, published: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates that are not published yet, with their deterministic publication_id."""
    from veritide.functions.ids import stable_id

    marked = candidates.withColumn("publication_id", stable_id("publication", *keys))
    return marked.dropDuplicates(["publication_id"]).join(published.select("publication_id"), "publication_id", "left_anti")


def drain(stream: DataFrame, checkpoint: str, target: str, key: str | None = None, at: str | None = None, name: str = "stream") -> None:
    """Runs a stream over all files there are and stops: appends to a Parquet table, new ids only if a key is given (see append_new)."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(append_new(target, key, at, name=name)) if key else writer.format("parquet").option("path", target).outputMode("append")
    writer.start().awaitTermination()


def rebuild(log: DataFrame, key: str, at: str, record: str, team: str, kickoff: str, metadata: list[str], exclusions: DataFrame) -> DataFrame:
    """State of each key from its whole log: the last status, kickoff and whether it is excluded. The batch twin of identity_stream."""
    states = identity_states(log, key, at, record, team, kickoff, metadata)
    last = states.groupBy(key).agg(F.max_by(F.struct("status", kickoff, record), F.struct(at, record)).alias("_l"), F.count("*").alias("observations"))
    gone = exclusions.select(key).distinct().withColumn("excluded", F.lit(True))
    return last.join(gone, key, "left").select(key, "_l.*", "observations", F.coalesce("excluded", F.lit(False)).alias("excluded"))
