import datetime as dt
import json
import pickle

import pytest
from pyspark.sql import functions as F

from veritide.operators import asof
from veritide.plans import pipelines
from veritide.sources import facts, lines
from veritide.sources import odds as odds_files
from veritide.streaming import states


def rec(i, kind="QualityEvent", **more):
    return {"record_id": i, "record_type": kind, "schema_version": 1, "fixture_id": "1", "occurred_at": "2026-01-01T00:00:00Z"} | more


def write(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_import_is_idempotent_and_rejects_whole_files(spark, tmp_path):
    write(tmp_path / "a.jsonl", [rec("1"), rec("2"), rec("1"), rec("3", "Odd")])
    write(tmp_path / "b.jsonl", [rec("4"), "{broken", rec("5")])
    out = pipelines.import_facts(spark, str(tmp_path))
    assert sorted(r["record_id"] for r in out["new"].collect()) == ["1", "2", "3"]
    assert out["rejected"].count() == 3 and out["conflicts"].count() == 0 and [r["record_id"] for r in out["unsupported"].collect()] == ["3"]
    assert out["new"].first()["event_at"] == dt.datetime(2026, 1, 1)
    again = pipelines.import_facts(spark, str(tmp_path), out["new"].select("record_id"))
    assert again["new"].count() == 0


def test_typed_prices(spark, tmp_path):
    price = {"raw": "1,234.5", "decimal": "1,234.5"}
    write(tmp_path / "a.jsonl", [rec("1", "BookmakerMarketRow", market="ouzhi", opening={"home": price}, current={"home": {"decimal": ""}})])
    row = facts.typed(facts.scan(spark, str(tmp_path)), "BookmakerMarketRow").first()
    assert float(row["opening_home"]) == 1234.5 and row["current_home"] is None and row["market"] == "ouzhi"


def test_every_type_has_a_schema(spark, tmp_path):
    kinds = [*facts.TYPES, *facts.RESEARCH_TYPES]
    write(tmp_path / "a.jsonl", [rec(k, k) for k in kinds])
    log = facts.scan(spark, str(tmp_path))
    assert len(kinds) == 29
    for k in kinds:
        assert facts.typed(log, k).columns[0] == "record_id"
    assert [r["record_id"] for r in facts.typed(log, kinds[-1]).collect()] == [kinds[-1]]


def test_append_only(spark, tmp_path):
    names = {"a": [rec("x"), rec("n")], "b": [rec("y")], "c": [rec("q"), rec("z")], "e": [rec("v")]}
    for name, rows in names.items():
        write(tmp_path / f"{name}.jsonl", rows)
    end = len(json.dumps(rec("x")) + "\n")
    at = lambda name: f"file://{tmp_path}/{name}.jsonl"
    stored = [(at("a"), end, 1, 0, "x"), (at("b"), 10 * end, 10, 9 * end, "y"), (at("c"), end, 1, 0, "z"), (at("d"), end, 1, 0, "w"), (at("e"), end, 1, 0, "v")]
    before = spark.createDataFrame(stored, "file string, offset long, line long, last_start long, last_record_id string")
    got = {r["file"]: r["violation"] for r in facts.append_violations(spark, str(tmp_path), before).collect()}
    assert got == {at("b"): "shrunk", at("c"): "tail_changed", at("d"): "missing"}
    out = pipelines.import_facts(spark, str(tmp_path), None, before)
    assert [r["record_id"] for r in out["new"].collect()] == ["n"]  # of the file that only grew


def test_only_new_bytes_are_read(spark, tmp_path):
    first = "".join(json.dumps(rec(str(i))) + "\n" for i in range(500))
    (tmp_path / "a.jsonl").write_text(first)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b.jsonl").write_text(first)
    mark = facts.checkpoint(facts.scan(spark, str(tmp_path)))
    mark = spark.createDataFrame(mark.collect(), mark.schema)  # as stored
    added = "".join(json.dumps(rec(f"n{i}")) + "\n" for i in range(7))
    with open(tmp_path / "a.jsonl", "a") as f:
        f.write(added)
    done = lines.done_of(mark)
    planned = lines.Reader({"path": str(tmp_path), "checkpoints": json.dumps(done)}).partitions()
    assert sum(p.stop - p.start for p in planned) == len(added) and [p.file for p in planned] == [f"file://{tmp_path}/a.jsonl"]
    got = facts.scan(spark, str(tmp_path), mark)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r["record_id"], r["line"], r["start"] >= len(first)) for r in got.orderBy("line").collect()] == [(f"n{i}", 501 + i, True) for i in range(7)]


def test_bad_utf8_rejects_a_file(spark, tmp_path):
    write(tmp_path / "a.jsonl", [rec("1")])
    (tmp_path / "b.jsonl").write_bytes(json.dumps(rec("2")).encode() + b"\n" + json.dumps(rec("3", note="x")).encode().replace(b"x", b"\xff") + b"\n")
    out = pipelines.import_facts(spark, str(tmp_path))
    assert [r["record_id"] for r in out["new"].collect()] == ["1"] and out["rejected"].count() == 2


def test_stored_ids_with_other_content_are_conflicts(spark, tmp_path):
    write(tmp_path / "a.jsonl", [rec("1"), rec("2")])
    stored = pipelines.import_facts(spark, str(tmp_path))["new"].select("record_id", "sha256")
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    write(tmp_path / "b.jsonl", [rec("1"), rec("2", note="other"), rec("3")])
    out = pipelines.import_facts(spark, str(tmp_path), stored)
    assert [r["record_id"] for r in out["conflicts"].collect()] == ["2"] and [r["record_id"] for r in out["new"].collect()] == ["3"]


def test_torn_tails_wait_and_bad_lines_reject_files(spark, tmp_path):
    """A last line without its end is left for later, readable or not; what it was is read once it is complete."""
    whole = json.dumps(rec("1")) + "\n" + "\n" + json.dumps(rec("2", note="ü")) + "\n"
    (tmp_path / "a.jsonl").write_text(whole + json.dumps(rec("3"))[:20])
    (tmp_path / "b.jsonl").write_text(json.dumps(rec("4")))
    (tmp_path / "c.jsonl").write_text("")
    out = pipelines.import_facts(spark, str(tmp_path))
    assert sorted(r["record_id"] for r in out["new"].collect()) == ["1", "2"] and out["rejected"].count() == 0
    mark = out["checkpoints"].collect()
    assert [(r["offset"], r["line"], r["last_record_id"]) for r in mark] == [(len(whole.encode()), 3, "2")]
    stored = spark.createDataFrame(mark, out["checkpoints"].schema)
    (tmp_path / "a.jsonl").write_text(whole + json.dumps(rec("3")) + "\n")
    (tmp_path / "b.jsonl").write_text(json.dumps(rec("4")) + "\n{broken\n")
    later = pipelines.import_facts(spark, str(tmp_path), None, stored)
    assert sorted(r["record_id"] for r in later["new"].collect()) == ["3"] and later["rejected"].count() == 2 and later["violations"].count() == 0
    (tmp_path / "a.jsonl").write_text(json.dumps(rec("9")) + "\n")
    assert [r["violation"] for r in pipelines.import_facts(spark, str(tmp_path), None, stored)["violations"].collect()] == ["shrunk"]


def test_lines_keep_their_numbers_in_any_pieces(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(rec(str(i), pad="x" * (i % 50) + "y" * (9000 * (i % 700 == 0)))) + "\n" for i in range(3000)))
    (tmp_path / "b.jsonl").write_text(json.dumps(rec("last", pad="z" * 50_000)) + "\n\n" + json.dumps(rec("torn")))
    got = {}
    for size in (1 << 25, 20_000, 999):
        got[size] = {(r["record_id"], r["line"], r["start"]) for r in facts.scan(spark, str(tmp_path), piece=size).collect()}
    assert got[1 << 25] == got[20_000] == got[999] and {(i, n) for i, n, _ in got[999]} == {(str(i), i + 1) for i in range(3000)} | {("last", 1)}


def test_many_small_files_take_few_tasks(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('{\"record_id\":\"', id, '\",\"record_type\":\"Odd\",\"schema_version\":1}') AS value", "id % 4 AS part", "id % 100 AS chunk", "id")
    assert lines.write(rows, ["part", "chunk"], ["id"], f"file://{tmp_path}/log") == 100
    scanned = facts.scan(spark, f"{tmp_path}/log")
    assert scanned.rdd.getNumPartitions() <= 8
    assert {(r["record_id"], r["line"]) for r in scanned.collect()} == {(str(i), i // 100 + 1) for i in range(2000)}
    text = (tmp_path / "log/part=3/chunk=7/lines.txt").read_text().splitlines()
    assert [json.loads(t)["record_id"] for t in text] == [str(i) for i in range(7, 2000, 100)] and not list(tmp_path.rglob("_*"))
    files = lines.listed(f"{tmp_path}/log")
    done = {f: [n, 20, 0] for f, n in files.items()}
    reader = lines.Reader({"path": f"{tmp_path}/log", "mode": "tails", "tasks": "4", "checkpoints": json.dumps(done)})
    assert [len(p.pieces) in (24, 25, 26) for p in reader.partitions()] == [True] * 4 and len(pickle.dumps(reader)) < 1000  # checkpoints stay with the driver
    assert lines.appended(spark, f"{tmp_path}/log", "tails", done).where("raw is not null").count() == 100


def test_an_import_reads_its_lines_once_for_each_output(spark, tmp_path):
    write(tmp_path / "a.jsonl", [rec("1"), rec("2", occurred_at="never"), rec("2")])
    (tmp_path / "b.jsonl").write_text(json.dumps(rec("3")).replace("occurred_at", "\\u006fccurred_at") + "\n" + json.dumps(rec("4", observed_at={"parsed": "2026-02-01T00:00:00Z"})) + "\n")
    write(tmp_path / "c.jsonl", [rec("5"), "{broken"])
    out = pipelines.import_facts(spark, str(tmp_path))
    assert {r["record_id"]: r["event_at"] and r["event_at"].month for r in out["new"].collect()} == {"1": 1, "2": None, "3": 1, "4": 2}
    for name in ("new", "rejected", "conflicts"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("appended_lines") == 1 and "strategy=broadcast" in plan
    assert out["rejected"].count() == 2 and [r["record_id"] for r in out["conflicts"].collect()] == ["2"]


def test_sealed_files_are_read_as_their_text(spark, tmp_path):
    rows = spark.range(30_000).selectExpr("concat('{\"record_id\":\"', id, '\",\"record_type\":\"Odd\",\"schema_version\":1,\"x\":\"', repeat(sha2(string(id), 256), 2), '\"}') AS value", "id % 2 AS part", "id")
    for sealed, name in ((False, "plain"), (True, "sealed")):
        assert lines.write(rows, ["part"], ["id"], f"file://{tmp_path}/{name}", sealed) == 2
    files = {name: lines.listed(f"{tmp_path}/{name}") for name in ("plain", "sealed")}
    assert sum(files["sealed"].values()) < 0.7 * sum(files["plain"].values()) and all(f.endswith(lines.SEALED) for f in files["sealed"])
    got = {name: {(r["record_id"], r["line"], r["start"], r["stop"]) for r in facts.scan(spark, f"{tmp_path}/{name}", piece=300_000).collect()} for name in files}
    assert got["plain"] == got["sealed"] and len(got["plain"]) == 30_000
    mark = facts.checkpoint(facts.scan(spark, f"{tmp_path}/sealed"))
    mark = spark.createDataFrame(mark.collect(), mark.schema)
    assert facts.scan(spark, f"{tmp_path}/sealed", mark).count() == 0 and facts.append_violations(spark, f"{tmp_path}/sealed", mark).count() == 0
    earlier = mark.withColumns({"offset": F.col("last_start"), "line": F.col("line") - 1})
    assert sorted(r["record_id"] for r in facts.scan(spark, f"{tmp_path}/sealed", earlier).collect()) == ["29998", "29999"]
    longer = mark.withColumn("offset", F.col("offset") + 1)
    assert {r["violation"] for r in facts.append_violations(spark, f"{tmp_path}/sealed", longer).collect()} == {"shrunk"}


def test_patched_json(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [1, {"c": "x"}]}',), ('{"a": null}',)], "j string")
    got = [json.loads(r["p"]) for r in df.select(facts.patched("j", {"a": F.lit("new"), "k": F.lit(2)}).alias("p")).collect()]
    assert got == [{"a": "new", "b": [1, {"c": "x"}], "k": 2}, {"a": "new", "k": 2}]
    kept = [json.loads(r["p"]) for r in df.select(facts.patched("j", {"a": F.lit("new"), "k": F.lit(2)}, only_missing=True).alias("p")).collect()]
    assert kept == [{"a": 1, "b": [1, {"c": "x"}], "k": 2}, {"a": None, "k": 2}]


def test_blobs_manifests_and_runs(spark, tmp_path):
    (tmp_path / "m1").write_text("one")
    (tmp_path / "m2").write_text("two")
    found = facts.blobs(spark, str(tmp_path))
    old = found.select("path", F.when(F.col("path").endswith("m1"), F.col("sha256")).otherwise("other").alias("sha256"))
    assert sorted(r["status"] for r in facts.manifest_changes(found, old).collect()) == ["changed", "existing"]
    listed = found.select(F.lit("r").alias("run_id"), "path", "size", "sha256")
    assert facts.completed_runs(listed, found).first()["complete"]
    assert not facts.completed_runs(listed, found.where(F.col("path").endswith("m1"))).first()["complete"]


def test_batch_gate(spark):
    m = spark.createDataFrame([("a", "completed", "h", 3, {"x": 2, "y": 1}), ("b", "completed", "h", 9, {"x": 1}), ("c", "completed", None, None, None)], "path string, status string, sha256 string, lines long, types map<string,long>")
    c = spark.createDataFrame([("a", "h", "x"), ("a", "h", "x"), ("a", "h", "y"), ("b", "g", "x"), ("c", "z", "x")], "path string, sha256 string, record_type string")
    assert {r["path"]: r["failed"] for r in facts.batch_gate(m, c).collect()} == {"a": [], "b": ["sha256", "lines"], "c": []}


def test_write_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert [facts.write_once(df, str(tmp_path / "t"), "r1", "k") for _ in range(2)] == ["written", "unchanged"]
    with pytest.raises(ValueError):
        facts.write_once(df.withColumn("v", F.lit("b")), str(tmp_path / "t"), "r1", "k")
    assert facts.read_runs(spark, str(tmp_path / "t")).count() == 1


def test_day_partitions_and_catalogue(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2, 3), "x")], "at timestamp, content string")
    facts.append_by_day(df, str(tmp_path / "d"), "at")
    assert (tmp_path / "d/yyyy=2026/mm=01/dd=02").is_dir()
    cat, obs = facts.content_catalogue(df.union(df))
    assert cat.first()["observations"] == 2 and obs.count() == 2


def test_odds_csv_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,B365H,B365D,B365A\nE0,05/03/2026,A,B,1,0,2.0,3.0,4.0\nE0,bad,A,B,1,0,2,3,4\n")
    (tmp_path / "b.csv").write_text("League,Date,Home,Away,HG,AG,AvgCH,AvgCD,AvgCA\nL,05/03/2026,C,D,2,2,2.0,3.0,4.0\nL,05/03/2026,,D,2,2,2.0,3.0,1.0\n")
    df = odds_files.odds_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    fixtures, markets, skips = pipelines.normalise_odds(df, "s")
    assert fixtures.count() == 2 and {r["cohort"] for r in markets.collect()} == {"opening", "closing"}
    assert {r["skip_reason"]: r["n"] for r in skips.collect()} == {None: 2, "invalid_date": 1, "missing_identity": 1}
    points = pipelines.baseline_points(fixtures, markets)
    cube = pipelines.evaluate_baseline(points).where("year = 'all' and competition = 'all' and baseline = 'uniform'").first()
    assert cube["sample_size"] == 1 and cube["log_loss"] == pytest.approx(1.0986, abs=1e-4)


def test_odds_history(spark):
    row = [("m", dt.datetime(2026, 1, 2), [{"market": "1x2", "rows": [{"bookmaker": "b", "period": "full", "groups": [{"history": [{"timestamp": dt.datetime(2026, 12, 30), "odds": 150}], "opening": {"timestamp": dt.datetime(2025, 12, 1), "odds": 0}}]}]}])]
    s = "match_id string, kickoff timestamp, markets array<struct<market:string,rows:array<struct<bookmaker:string,period:string,groups:array<struct<history:array<struct<timestamp:timestamp,odds:int>>,opening:struct<timestamp:timestamp,odds:int>>>>>>>"
    good, bad = odds_files.odds_history(spark.createDataFrame(row, s))
    assert [(r["odds"], r["time_status"]) for r in good.collect()] == [(2.5, "year_corrected")] and bad.count() == 1


def test_manual_results_and_feed(spark):
    df = spark.createDataFrame([("1", "1", "0"), ("2", "1", "1"), ("x", "1", "1"), ("3", "-1", "1"), ("4", "2", "2")], "fixture_id string, home_goals string, away_goals string")
    old = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "fixture_id long, home_goals int, away_goals int")
    new, bad, rejected = odds_files.manual_results(df, old)
    assert [r["fixture_id"] for r in new.collect()] == [4] and [r["fixture_id"] for r in bad.collect()] == [2] and rejected.count() == 2
    feed = spark.createDataFrame([('{"value": {"matchResult": [{"a": "1"}, {"a": "2"}], "pages": 3}}',), ('{"rows": [{"a": "9"}]}',)], "body string")
    got = odds_files.feed_rows(feed)
    assert [(r["row"]["a"], r["total_pages"]) for r in got.collect()] == [("1", 3), ("2", 3), ("9", 1)]


EVENTS = "event_id long, ts timestamp, kind string"


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i % 40, dt.datetime(2026, 1, 1, 10) + dt.timedelta(hours=3 * (i % 40)), "a" if i % 3 else "b") for i in range(60)]
    df = spark.createDataFrame(rows, EVENTS)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    states.drain(stream, str(tmp_path / "ck"), str(tmp_path / "out"), "event_id", "ts")
    states.drain(stream, str(tmp_path / "ck2"), str(tmp_path / "out"), "event_id", "ts", "second")  # another run over the same rows adds nothing
    got = states.appended_rows(spark, str(tmp_path / "out"))
    assert got.count() == 40 and got.columns == df.columns
    states.drain(states.daily_counts(stream, "ts", ["kind"]), str(tmp_path / "ck3"), str(tmp_path / "days"))
    got = {(r["day_start"], r["kind"]): r["n"] for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    want = {(r["day_start"], r["kind"]): r["n"] for r in states.daily_counts(df, "ts", ["kind"]).collect()}
    assert got and got.items() <= want.items()  # windows that the watermark has closed
    once = states.claim_once(df, "event_id", "ts", "1 day")
    assert once.count() == 40


def test_the_sink_skips_replays_and_reads_days_beside_alone(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    batch = lambda ids, day: spark.createDataFrame([(i, dt.datetime(2026, 1, day, 5), "a") for i in ids], EVENTS)
    sink = states.append_new(target, "event_id", "ts")
    read = []
    path_read = spark.read.__class__.parquet
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *paths, **o: read.append(paths) or path_read(self, *paths, **o))
    for epoch in range(12):
        sink(batch(range(10 * epoch, 10 * epoch + 10), epoch + 1), epoch)
    assert max(map(len, read)) == 1  # the day before, however many there are
    count = lambda: states.appended_rows(spark, target).count()
    assert count() == 120
    sink(batch(range(110, 120), 12), 11)  # a replay of an epoch that is done
    assert count() == 120
    sink(batch(range(115, 125), 12), 12)  # half known
    assert count() == 125
    # an attempt that wrote and died before its mark: its rows don't count until it runs again, and then once
    (tmp_path / "out/_epochs/stream-12").unlink()
    assert count() == 120
    sink(batch(range(115, 125), 12), 12)
    assert count() == 125


def test_plan_stream_equals_batch(spark, tmp_path):
    """A moved kickoff supersedes what is open, cutoffs expire when their time comes, rows arrive out of order and in several batches."""
    t = lambda d, h=0: dt.datetime(2026, 1, d, h)
    rows = [
        ("1", t(1), "a", t(10)), ("1", t(3), "c", t(12)), ("1", t(2), "b", t(10)),
        ("2", t(4), "e", t(4, 8)), ("2", t(4, 2), "f", t(4, 8)), ("3", t(5), "g", t(20)),
        ("1", t(11, 20), "d", t(11, 22)), ("4", t(13), "h", t(13, 1)), ("5", t(14, 1), "i", t(30)),
    ]
    df = spark.createDataFrame(rows, "fixture_id string, observed_at timestamp, record_id string, kickoff_at timestamp")
    later = [("9", t(14, 2), "z", t(30))]  # what a watermark reaches comes with the next rows
    for i, part in enumerate((rows[:3], rows[3:6], rows[6:], later)):
        spark.createDataFrame(part, df.schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    named = asof.targets(spark, ("T-24h", "T-6h", "T-10m"))
    batch = states.plan_events(df, named, F.lit(t(11, 1)))  # the last row's time less the delay
    want = sorted(map(tuple, batch.collect()))
    assert {r[4] for r in want} == {"pending", "missed_before_discovery", "superseded", "expired"}
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
        minutes = {r["target"]: r["minutes"] for r in named.collect()}
        states.drain(states.plan_stream(stream, minutes, "3 days"), str(tmp_path / "ck"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*batch.columns).collect())) == want


def test_identity_stream_equals_batch(spark, tmp_path):
    k = dt.datetime(2026, 1, 5)
    obs = [("1", "T", k, "x"), ("1", "T", k, "x"), ("1", "T", k, "y"), ("1", "T", k + dt.timedelta(hours=1), "y"), ("1", "U", k, "y"), ("1", "T", k, "y"), ("2", "V", k, "x")]
    rows = [(f, dt.datetime(2026, 1, 1, 0, i), str(i), team, at, label) for i, (f, team, at, label) in enumerate(obs)]
    df = spark.createDataFrame(rows, "fixture_id string, observed_at timestamp, record_id string, team string, kickoff_at timestamp, label string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = {r["record_id"]: r["status"] for r in states.identity_states(df, "fixture_id", "observed_at", "record_id", "team", "kickoff_at", ["label"]).collect()}
    assert [batch[str(i)] for i in range(7)] == ["new", "unchanged", "metadata_changed", "kickoff_changed", "identity_conflict", "identity_conflict", "new"]
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    states.drain(states.identity_stream(stream, "1 hour"), str(tmp_path / "ck"), str(tmp_path / "out"))
    assert {r["record_id"]: r["status"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == batch


def test_checks_and_publication(spark):
    fx = spark.createDataFrame([("1", dt.datetime(2026, 1, 1))], "fixture_id string, kickoff_at timestamp")
    got = {r["name"]: r["status"] for r in states.result_checks(fx, "kickoff_at", F.lit(dt.datetime(2026, 1, 1, 7))).collect()}
    assert got["T+6h"] == "due" and got["R+2d"] == "pending" and len(got) == 9
    none = spark.createDataFrame([], "publication_id string")
    first = states.publish_once(fx.union(fx), none, ["fixture_id"])
    assert first.count() == 1 and states.publish_once(fx, first, ["fixture_id"]).count() == 0
