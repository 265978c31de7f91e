"""Append-only fact logs: scan, contract, idempotent append, immutability and publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritide.functions.parse import event_time
from veritide.operators.staged import staged
from veritide.sources import lines as lines_source

ENVELOPE = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("schema_version", T.IntegerType()), T.StructField("fixture_id", T.StringType())])
#: Columns of the first non-empty of which a record's event time is read.
EVENT_TIMES = ("observed_at", "occurred_at", "confirmed_at", "completed_at", "normalized_at", "assessed_at")

_price = "struct<raw:string,decimal:string>"
_prices = f"struct<home:{_price},draw:{_price},away:{_price},line:{_price},over:{_price},under:{_price}>"
#: Payload schema of each typed table (DDL).
TYPES = {
    "FixtureIdentity": "fixture_id string, observed_at string, kickoff_at string, buy_end_at string, competition_id string, competition_name string, season_id string, match_number string, home_team_id string, home_team_name string, away_team_id string, away_team_name string, identity_status string",
    "DiscoveryObservation": "fixture_id string, observed_at string, kickoff_at string, source_name string, source_url string, row_sha256 string",
    "SportteryPoolObservation": "fixture_id string, observed_at string, source_name string, pool_type string, option_value string, handicap_raw string, sp_raw string, sp_decimal string",
    "SnapshotBatch": "fixture_id string, target string, job_id string, window_start string, window_end string, completed_at string, core_market_complete boolean, strict_eligible boolean, market_results map<string,struct<status:string,snapshot_record_id:string,observed_at:string,clock_ok:boolean,valid_bookmaker_rows:int,normalization_status:string>>",
    "MarketSnapshot": "fixture_id string, market string, target string, observed_at string, ingested_at string, corrected_at string, raw_sha256 string, parser_version string, parse_status string, clock_ok boolean, bookmaker_count int, row_count int",
    "BookmakerMarketRow": f"fixture_id string, market string, target string, observed_at string, corrected_at string, source_bookmaker_id string, source_bookmaker_name string, row_role string, opening {_prices}, current {_prices}, source_snapshot_record_id string, normalization_record_id string, source_row_index int, line_movement string",
    "MarketNormalization": "fixture_id string, snapshot_record_id string, market string, target string, normalization_version string, normalized_at string, status string, valid_bookmaker_rows int, line_parse_failure_count int, quality_reasons array<string>",
    "SnapshotEligibilityAssessment": "fixture_id string, snapshot_batch_record_id string, target string, assessment_version string, assessed_at string, collection_eligible boolean, data_complete boolean, model_strict_eligible boolean, ineligibility_reasons array<string>",
    "HandicapIndexRow": "fixture_id string, target string, observed_at string, source_bookmaker_name string, handicap_line string, home_index string, draw_index string, away_index string, home_probability string, draw_probability string, away_probability string, return_rate string",
    "SportteryScopeEvidence": "scope_id string, observed_at string, accepted boolean",
    "SportteryInventoryBatch": "inventory_id string, scope_id string, completed_at string, complete boolean, total_pages int",
    "SportteryFixtureLink": "link_id string, inventory_id string, fixture_id string, match_id string, observed_at string, status string",
    "SportteryResultObservation": "observation_id string, link_id string, fixture_id string, observed_at string, home_goals int, away_goals int, scope string",
    "ResultCandidate": "fixture_id string, observed_at string, kickoff_at string, home_goals int, away_goals int, scope string, status_code int, analysis_consistency string",
    "VerifiedResult": "fixture_id string, confirmed_at string, home_goals int, away_goals int, scope string, verification_method string, verification_status string, candidate_id string, supersedes_record_id string",
    "QualityEvent": "occurred_at string, event_type string, status string, fixture_id string, competition string, market string, cutoff string, details string",
}
_assessment = "fixture_id string, target string, prediction_cutoff string, assessed_at string, policy_sha256 string, raw_features string, rule_evaluations map<string,struct<status:string,reasons:array<string>>>, rule_flags array<string>, proposed_action string, proposed_confidence_cap string, reasons array<string>, audit_status string"
_evaluation = "evaluated_at string, model_key string, model_version string, result_set_hash string, metrics string"
#: Payload schemas of the research records.
RESEARCH_TYPES = {
    "ResearchSourceAsset": "source_id string, asset_id string, url string, asset_kind string, sha256 string, size_bytes long, blob_path string, downloaded_at string",
    "ResearchFixture": "source_id string, source_asset_record_id string, source_fixture_key string, competition string, match_date date, home_team string, away_team string, home_goals int, away_goals int, result_scope string, result_eligible boolean",
    "ResearchMarketObservation": "fixture_record_id string, source_id string, asset_sha256 string, cohort string, market string, bookmaker string, line string, values map<string,double>, market_contract string",
    "ResearchFeatureRow": "source_fixture_key string, competition string, match_date date, season string, cohort string, feature_schema string, features map<string,string>",
    "ResearchQualityEvent": "occurred_at string, event_type string, status string, details string",
    "ResearchModelDataset": "model_key string, dataset_hash string, training_before_date date, created_at string, source_record_count long, fixture_count long, feature_schema string",
    "ResearchModelVersion": "model_key string, model_version string, dataset_record_id string, trained_at string, algorithm string, metrics string",
    "ResearchModelActivation": "channel string, model_key string, model_version string, model_record_id string, activated_at string, active_from string, active_until string, status string",
    "ResearchShadowPrediction": "channel string, fixture_id string, target string, prediction_cutoff string, published_at string, status string, model_key string, model_version string, probabilities map<string,double>, abstention_reason string, competition_id string, market_evidence_tier string, classification_status string, raw_confidence_label string, competition_confidence_cap string, confidence_label string",
    "ResearchK1GuardrailAssessment": _assessment,
    "ResearchEuropeGuardrailAssessment": _assessment,
    "ResearchRetrospectiveEvaluation": _evaluation,
    "ResearchShadowEvaluation": _evaluation,
}
PRICES = ("home", "draw", "away", "line", "over", "under")


#: So many rows (file, piece, lines) are broadcast at most, some 20 MB.
SMALL = 200_000


def scan(spark: SparkSession, path: str, checkpoints: DataFrame | None = None, piece: int = lines_source.PIECE) -> DataFrame:
    """Lines of a JSONL tree with their envelope: raw, utf8, file, line (from 1), start and stop (bytes in the file), and the fields of ENVELOPE.

    A last line without a line end is left for a later scan, whether it is JSON or not. checkpoints: (file, offset, line, last_start, ...) of
    checkpoint(); of a file that has one only the bytes after it are read, and its lines are numbered on from there. Added bytes are read in pieces; only
    files with more than one are read twice, first to count the lines before each later piece. Nothing is shuffled unless there are more than SMALL of these.
    """
    done = lines_source.done_of(checkpoints)
    read = lines_source.appended(spark, path, "lines", done, piece)
    later = lines_source.later_pieces(path, done, piece)
    if later:
        earlier = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        before = lines_source.appended(spark, path, "counts", done, piece).select("file", "piece", F.sum("lines").over(earlier).alias("_before"))
        read = read.join(F.broadcast(before) if later <= SMALL else before, ["file", "piece"], "left").withColumn("base", F.col("base") + F.coalesce("_before", F.lit(0)))
    numbered = read.withColumn("line", F.col("base") + F.col("place")).where(F.trim("raw") != "")
    return numbered.withColumn("e", F.from_json("raw", ENVELOPE)).select("raw", "utf8", "file", "line", "start", "stop", "e.*")


def checkpoint(lines: DataFrame) -> DataFrame:
    """(file, offset, line, last_start, last_record_id): how far a scan has come in each file."""
    return lines.groupBy("file").agg(F.max("stop").alias("offset"), F.max("line").alias("line"), F.max("start").alias("last_start"), F.max_by("record_id", "line").alias("last_record_id"))


def record_contract(version: int = 1) -> dict[str, Column]:
    return {
        "utf8": F.col("utf8"),
        "not_an_object": F.get_json_object("raw", "$").startswith("{"),
        "record_id": F.trim("record_id") != "",
        "record_type": F.trim("record_type") != "",
        "schema_version": F.col("schema_version") == version,
    }


def validated(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): a file with one bad line is rejected as a whole.

    The names of bad files are looked for at once and stored, so what is made of the two reads the lines once each, and shuffles none of them for up to SMALL names.
    """
    ok = F.lit(True)
    for check in record_contract().values():
        ok = ok & F.coalesce(check, F.lit(False))
    bad = staged(lines.where(~ok).select("file").distinct())
    bad = F.broadcast(bad) if bad.count() <= SMALL else bad
    return lines.join(bad, "file", "left_anti"), lines.join(bad, "file", "left_semi")


def with_event_time(records: DataFrame) -> DataFrame:
    # a name that stands nowhere in the text, nor any escape that could spell it, needs no parsing
    there = lambda n: F.col("raw").contains(n) | F.col("raw").contains("\\u")
    named = records.withColumns({f"_{n}": F.when(there(n), F.coalesce(F.get_json_object("raw", f"$.{n}.parsed"), F.get_json_object("raw", f"$.{n}"))) for n in EVENT_TIMES})
    return named.withColumn("event_at", event_time(*(f"_{n}" for n in EVENT_TIMES))).drop(*(f"_{n}" for n in EVENT_TIMES))


def new_records(records: DataFrame, stored: DataFrame | None, key: str = "record_id", order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    """Records not stored yet; of repeats within the input the first stays. A replay gives none."""
    row = F.struct(*order, *(c for c in records.columns if c not in (key, *order)))
    first = records.groupBy(key).agg(F.min(row).alias("_row")).select(key, "_row.*")
    return first if stored is None else first.join(stored.select(key), key, "left_anti")


def typed(records: DataFrame, kind: str) -> DataFrame:
    """Rows of one record type; prices of market rows also as twelve decimal columns."""
    rows = records.where(F.col("record_type") == kind).select("record_id", F.from_json("raw", (TYPES | RESEARCH_TYPES)[kind]).alias("p")).select("record_id", "p.*")
    if kind == "BookmakerMarketRow":
        rows = rows.withColumns({f"{side}_{p}": F.expr(f"try_cast(nullif(replace({side}.{p}.decimal, ',', ''), '') AS decimal(18,8))") for side in ("opening", "current") for p in PRICES})
    return rows


def conflicts(records: DataFrame, stored: DataFrame | None = None, key: str = "record_id", content: str = "raw") -> DataFrame:
    """Ids that stand for more than one content, among the records and, with stored (key, sha256), those stored before."""
    hashes = records.select(key, F.sha2(content, 256).alias("sha256"))
    if stored is not None:
        hashes = hashes.unionByName(stored.select(key, "sha256").join(records.select(key), key, "left_semi"))
    return hashes.groupBy(key).agg(F.count_distinct("sha256").alias("contents")).where("contents > 1")


def append_violations(spark: SparkSession, path: str, before: DataFrame) -> DataFrame:
    """(file, violation): files of stored checkpoints that vanished, shrank below their offset, or have another record at it. Of each file its last known line is read alone."""
    now = lines_source.appended(spark, path, "tails", lines_source.done_of(before))
    there = F.from_json("raw", ENVELOPE)["record_id"]
    j = before.join(now.select("file", F.col("size").alias("_size"), there.alias("_there")), "file")
    v = F.when(F.col("_size").isNull(), "missing").when(F.col("_size") < F.col("offset"), "shrunk").when(~F.col("_there").eqNullSafe(F.col("last_record_id")), "tail_changed")
    return j.select("file", v.alias("violation")).where("violation is not null")


def patched(column: str, additions: dict[str, Column], only_missing: bool = False) -> Column:
    """A JSON object as text with top-level fields set, the others as they are; only_missing keeps fields that are there."""
    old = F.from_json(column, "map<string,variant>")
    names = F.array(*map(F.lit, additions))
    new = F.create_map(*(x for k, c in additions.items() for x in (F.lit(k), F.parse_json(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)))))
    if only_missing:
        added = F.map_filter(new, lambda k, v: ~F.array_contains(F.map_keys(old), k))
        return F.to_json(F.map_concat(old, added))
    return F.to_json(F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(names, k)), new))


def blobs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, sha256) of files, hashed where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def manifest_changes(found: DataFrame, stored: DataFrame) -> DataFrame:
    """(path, status): new, existing or changed, against stored (path, sha256)."""
    s = stored.select("path", F.col("sha256").alias("_old"))
    return found.join(s, "path", "left").select("path", "sha256", F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("sha256"), "existing").otherwise("changed").alias("status"))


def completed_runs(listed: DataFrame, found: DataFrame) -> DataFrame:
    """(run_id, complete): every listed file is there with its size and hash."""
    f = found.select("path", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    return listed.join(f, "path", "left").groupBy("run_id").agg(F.bool_and(F.coalesce((F.col("size") == F.col("_size")) & (F.col("sha256") == F.col("_sha")), F.lit(False))).alias("complete"))


def batch_gate(manifests: DataFrame, content: DataFrame) -> DataFrame:
    """(path, failed): checks of published batches. manifests: path, status, sha256, lines, types (map); content: path, sha256, record_type.

    A manifest without a hash needs its status and path only.
    """
    per = content.groupBy("path", "record_type").agg(F.count("*").alias("n"), F.min("sha256").alias("_sha"))
    got = per.groupBy("path").agg(F.sum("n").alias("_lines"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("record_type", "n")))).alias("_types"), F.min("_sha").alias("_sha"))
    j = manifests.join(got, "path", "left")
    new = F.col("sha256").isNotNull()
    differs = F.exists(F.map_keys("types"), lambda k: ~F.coalesce(F.try_element_at("_types", k), F.lit(0)).eqNullSafe(F.try_element_at("types", k)))
    failed = F.array_compact(
        F.array(
            F.when(F.col("status") != "completed", "status"), F.when(F.col("_lines").isNull(), "missing_file"), F.when(new & ~F.col("sha256").eqNullSafe(F.col("_sha")), "sha256"),
            F.when(new & ~F.col("lines").eqNullSafe(F.col("_lines")), "lines"), F.when(new & (differs | ~F.size("types").eqNullSafe(F.size("_types"))), "types"),
        )
    )
    return j.select("path", failed.alias("failed"))


def content_catalogue(observed: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(catalogue, observations): each content once by its hash, and every observation of it."""
    hashed = observed.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))
    return hashed.groupBy("sha256").agg(F.any_value(content).alias(content), F.count("*").alias("observations")), hashed.drop(content)


def append_by_day(df: DataFrame, path: str, at: str) -> None:
    """Appends Parquet partitioned by day."""
    df.withColumns({"yyyy": F.date_format(at, "yyyy"), "mm": F.date_format(at, "MM"), "dd": F.date_format(at, "dd")}).write.mode("append").partitionBy("yyyy", "mm", "dd").parquet(path)


def write_once(df: DataFrame, path: str, run_id: str, key: str) -> str:
    """Publishes a run: 'written', or 'unchanged' if it stands with the same content; other content is an error.

    The one-row manifest is written last, and readers (read_runs) follow manifests only.
    """
    spark = df.sparkSession
    mark = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64(*sorted(df.columns))), F.lit(0)).alias("h")).first()
    done = f"{path}/manifests"
    try:
        old = spark.read.parquet(done).where(F.col("run_id") == run_id).first()
    except Exception as e:  # no manifest yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old:
        if (old["n"], old["h"]) != (mark["n"], mark["h"]):
            raise ValueError(f"run {run_id} stands with other content")
        return "unchanged"
    df.write.mode("overwrite").parquet(f"{path}/runs/run_id={run_id}")
    spark.createDataFrame([(run_id, mark["n"], mark["h"])], "run_id string, n long, h long").write.mode("append").parquet(done)
    return "written"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/runs").join(spark.read.parquet(f"{path}/manifests").select("run_id"), "run_id", "left_semi")


def report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
