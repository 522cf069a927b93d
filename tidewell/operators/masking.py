"""Masking on load: row rules, JSON key removal by rule table, values nulled by endpoint, leak checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import json_text
from tidewell.functions.text import first_letter_mask
from tidewell.operators.matching import lookup


def mask_rows(
    df: DataFrame, rule: Column, first_letter: Sequence[str], cleared: Sequence[str], null_masks: bool = False
) -> DataFrame:
    """Mask the rows the rule holds for, and say so in ``is_masked``; works on batch and streaming input alike.

    A rule that is NULL does not mask (as a WHERE would not select the row) unless ``null_masks`` is set.
    """
    hit = F.coalesce(rule, F.lit(null_masks))
    out = []
    for c in df.columns:
        if c in first_letter:
            out.append(F.when(hit, first_letter_mask(F.col(c))).otherwise(F.col(c)).alias(c))
        elif c in cleared:
            out.append(F.when(~hit, F.col(c)).alias(c))
        elif c != "is_masked":
            out.append(F.col(c))
    return df.select(*out, hit.alias("is_masked"))


def mask_stored(df: DataFrame, rule: Column, first_letter: Sequence[str], cleared: Sequence[str]) -> DataFrame:
    """The rewrite of a table that was loaded raw: matching rows are masked, rows masked before stay masked once."""
    earlier = df.withColumnRenamed("is_masked", "_earlier")
    masked = mask_rows(earlier, rule & ~F.col("_earlier"), first_letter, cleared)
    return masked.withColumn("is_masked", F.col("is_masked") | F.col("_earlier")).select(*df.columns)


def leak_report(df: DataFrame, rule: Column, first_letter: Sequence[str], cleared: Sequence[str]) -> DataFrame:
    """One row: rows, masked rows, rows the rule should have masked, masked rows with a raw value left."""
    raw_left = F.lit(False)
    for c in first_letter:
        raw_left = raw_left | ~F.col(c).like("%***")
    for c in cleared:
        raw_left = raw_left | F.col(c).isNotNull()
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if("is_masked").alias("masked"),
        F.count_if(rule & ~F.col("is_masked")).alias("rule_missed"),
        F.count_if(F.col("is_masked") & raw_left).alias("leaks"),
    )


def residue(files: DataFrame, rule: Column, column: str) -> DataFrame:
    """Raw values still readable, per file, over every file version under a table path."""
    return (
        files.withColumn("file", F.col("_metadata.file_path"))
        .groupBy("file")
        .agg(F.count_if(rule & ~F.col(column).like("%***")).alias("raw_values"), F.count("*").alias("rows"))
    )


# --- rule tables for JSON fields ---------------------------------------------------------------------------


def rule_paths(rules: DataFrame, keys: Sequence[str], class_column: str = "class", field_column: str = "field") -> DataFrame:
    """One row per rule key with its paths as an array.  Duplicated rules count once."""
    return (
        rules.select(*keys, F.struct(F.col(class_column).alias("class"), F.col(field_column).alias("field")).alias("p"))
        .distinct()
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("p")).alias("paths"))
    )


def mask_json_by_rules(df: DataFrame, text: str, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove each row's ``class.field`` paths, found by one lookup on the rule keys; no rule, no change."""
    none = F.array().cast("array<struct<class:string,field:string>>")
    found = lookup(df, rule_paths(rules, keys), keys, {"paths": none})
    cleaned = F.when(F.size("paths") == 0, F.col(text)).otherwise(json_text.drop_paths(F.col(text), F.col("paths")))
    return found.withColumn(text, cleaned).select(*df.columns)


def json_fields_left(df: DataFrame, text: str, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows where a rule's path is still present; none are expected after a load."""
    return (
        df.join(rule_paths(rules, keys), list(keys))
        .where(json_text.has_path(F.col(text), F.col("paths")))
        .select(*df.columns)
    )


# --- values set to null by endpoint --------------------------------------------------------------------------


def endpoint_keys(rules: DataFrame, endpoint: str = "endpoint", key: str = "key") -> DataFrame:
    """One row per endpoint with its distinct keys; blank endpoints and keys are no rules."""
    named = rules.select(F.trim(F.col(endpoint)).alias(endpoint), F.trim(F.col(key)).alias("_key"))
    return named.where((F.col(endpoint) != "") & (F.col("_key") != "")).groupBy(endpoint).agg(F.array_sort(F.collect_set("_key")).alias("_keys"))


def null_fields(df: DataFrame, text: str, rules: DataFrame, endpoint: str = "endpoint", key: str = "key") -> DataFrame:
    """Each row's text with the values of its endpoint's keys set to null; rows of other endpoints pass through.

    The rules are joined, so they may be a table of any size.
    """
    found = lookup(df, endpoint_keys(rules, endpoint, key), [endpoint], {"_keys": F.array().cast("array<string>")})
    cleaned = F.when(F.size("_keys") == 0, F.col(text)).otherwise(json_text.null_values(F.col(text), F.col("_keys")))
    return found.withColumn(text, cleaned).select(*df.columns)
