"""Model versions and their activation by channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.functions.ids import stable_id
from veritide.operators import versions


def model_version(dataset: DataFrame, model_key: str, trained_at: Column) -> DataFrame:
    """(record_id, model_key, model_version, dataset_hash, trained_at) of a dataset's hash (one row, dataset_hash): the version names the model, the data and the time."""
    at = F.date_format(trained_at, "yyyyMMdd'T'HHmmss'Z'")
    named = dataset.select(F.lit(model_key).alias("model_key"), F.concat_ws("-", F.lit(model_key), F.substring("dataset_hash", 1, 12), at).alias("model_version"), "dataset_hash", trained_at.alias("trained_at"))
    return named.withColumn("record_id", stable_id("research_model_version", "model_key", "model_version"))


def activation(version: DataFrame, channel: str, at: Column) -> DataFrame:
    """The activation of a version on a channel from a time on, open-ended."""
    return version.select(F.lit(channel).alias("channel"), "model_key", "model_version", F.col("record_id").alias("model_record_id"), at.alias("activated_at"), at.alias("active_from"), F.lit(None).cast("timestamp").alias("active_until"), F.lit("active").alias("status")).withColumn(
        "record_id", stable_id("research_model_activation", "channel", "model_record_id", "activated_at")
    )


def active_models(activations: DataFrame, now: Column) -> DataFrame:
    """The model that each channel runs at `now`: of its open activations the latest, ties to the greatest id."""
    return versions.active(activations, ["channel"], "active_from", "active_until", now, ["active_from", "activated_at", "record_id"], F.col("status") == "active")


def required_model(activations: DataFrame, channel: str, now: Column) -> DataFrame:
    """(model_key, model_version): the channel's one active model; none is an error."""
    found = active_models(activations.where(F.col("channel") == channel), now).select("model_key", "model_version")
    if found.isEmpty():
        raise ValueError(f"no model is active on channel {channel}")
    return found
