"""Contract validation (V1-V11) as one findings table.

Rule texts, severities and check names are fixed values (``feedloom.messages``).
With both tables complete, every rule count comes from one job that reads each
table once: interactions reduce per event key and then per item (partial
aggregates, so a hot key or copy group is one row when it crosses a shuffle),
items reduce per id, the two meet in a null-safe full outer join per item, and
one global aggregate yields all eight counts.  ``FINDING_SCHEMA`` is the
output contract.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import messages
from feedloom.functions.predicates import blank_text
from feedloom.schemas import EVENT_KEY, INTERACTION_REQUIRED, ITEM_REQUIRED, missing_columns

FINDING_SCHEMA = T.StructType([
    T.StructField("severity", T.StringType(), False),
    T.StructField("dataset", T.StringType(), False),
    T.StructField("check", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("affected_rows", T.LongType(), False),
])

RULES = messages.RULES


def _isna(df: DataFrame, name: str) -> Column:
    col = F.col(name)
    if df.schema[name].dataType.typeName() in ("float", "double"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _findings_from_counts(counts: DataFrame, checks: list[str]) -> DataFrame:
    """One-row frame of rule counts -> finding rows, in one projection (``stack``)."""
    args = []
    for check in checks:
        seq, severity, dataset, message = RULES[check]
        args += [F.lit(seq), F.lit(severity), F.lit(dataset), F.lit(check), F.lit(message),
                 F.col(check).cast("bigint")]
    return counts.select(F.stack(F.lit(len(checks)), *args)).toDF(
        "seq", "severity", "dataset", "check", "message", "affected_rows")


def _required_row(spark: SparkSession, seq: int, dataset: str, missing: list[str]) -> DataFrame:
    msg = messages.REQUIRED_COLUMNS.format(columns=", ".join(missing))
    return spark.createDataFrame(
        [(seq, "error", dataset, "required_columns", msg, 0)],
        "seq int, severity string, dataset string, check string, message string, affected_rows bigint")


def _interaction_flags(interactions: DataFrame) -> list[Column]:
    rating = F.col("rating")
    any_null = reduce(lambda a, b: a | b, [_isna(interactions, c) for c in sorted(INTERACTION_REQUIRED)])
    out_of_range = F.coalesce(F.isnan(rating) | ~rating.between(1.0, 5.0), F.lit(True))
    bad_time = F.coalesce(F.col("timestamp_ms") <= 0, F.lit(False))
    return [F.count_if(any_null).alias("_nulls"), F.count_if(out_of_range).alias("_bad_rating"),
            F.count_if(bad_time).alias("_bad_time")]


def _per_item_interactions(interactions: DataFrame) -> DataFrame:
    """Interactions reduced to one row per item, carrying every V2-V5 count.

    Two partial aggregates in a chain: per event key (duplicates collapse
    map-side, so a hot copy group is one row when it crosses the shuffle), then
    per item.  ``rows - keys`` per item sums to the duplicate-event count.
    """
    per_key = interactions.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("_n"), *_interaction_flags(interactions))
    return per_key.groupBy("item_id").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_keys"),
        F.sum("_nulls").alias("_nulls"), F.sum("_bad_rating").alias("_bad_rating"),
        F.sum("_bad_time").alias("_bad_time"))


def _per_item_id(items: DataFrame) -> DataFrame:
    return items.groupBy(F.col("item_id").alias("_t_id")).agg(
        F.count(F.lit(1)).alias("_t_n"), F.count_if(blank_text(F.col("item_text"))).alias("_t_blank"))


def _all_counts(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """V2-V9 in one job: each table is read once, joined per item (null-safe), summed."""
    left, right = _per_item_interactions(interactions), _per_item_id(items)
    joined = left.join(right, left["item_id"].eqNullSafe(right["_t_id"]), "full_outer")
    zero = F.lit(0)
    return joined.agg(
        F.coalesce(F.sum("_nulls"), zero).alias("null_required_values"),
        F.coalesce(F.sum("_bad_rating"), zero).alias("rating_range"),
        F.coalesce(F.sum("_bad_time"), zero).alias("timestamp_range"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_keys")), zero).alias("duplicate_events"),
        F.coalesce(F.sum(F.when(F.col("_t_n").isNotNull() & F.col("_t_id").isNull(), F.col("_t_n"))), zero)
        .alias("null_item_ids"),
        F.coalesce(F.sum(F.col("_t_n") - 1), zero).alias("duplicate_item_ids"),
        F.coalesce(F.sum("_t_blank"), zero).alias("missing_item_text"),
        F.coalesce(F.sum(F.when(F.col("_t_n").isNull(), F.col("_rows"))), zero).alias("interaction_item_join"),
    )


INTERACTION_CHECKS = ["null_required_values", "rating_range", "timestamp_range", "duplicate_events"]
ITEM_CHECKS = ["null_item_ids", "duplicate_item_ids", "missing_item_text"]


def validation_findings(interactions: DataFrame, items: DataFrame, ordered: bool = True) -> DataFrame:
    """Only rules with affected rows (or a missing-column error) appear.

    With both contracts present this is a single job (see ``_all_counts``).
    A table missing required columns gets the V1 error and skips its own
    rules; the cross-table rule still runs when both sides have ``item_id``.
    """
    spark = interactions.sparkSession
    inter_missing = missing_columns(interactions.columns, INTERACTION_REQUIRED)
    item_missing = missing_columns(items.columns, ITEM_REQUIRED)
    parts: list[DataFrame] = []
    if not inter_missing and not item_missing:
        parts.append(_findings_from_counts(_all_counts(interactions, items),
                                           INTERACTION_CHECKS + ITEM_CHECKS + ["interaction_item_join"]))
    else:
        if inter_missing:
            parts.append(_required_row(spark, 0, "interactions", inter_missing))
        else:
            per_item = _per_item_interactions(interactions).agg(
                F.sum("_nulls").alias("null_required_values"), F.sum("_bad_rating").alias("rating_range"),
                F.sum("_bad_time").alias("timestamp_range"),
                F.sum(F.col("_rows") - F.col("_keys")).alias("duplicate_events"))
            parts.append(_findings_from_counts(per_item, INTERACTION_CHECKS))
        if item_missing:
            parts.append(_required_row(spark, 5, "items", item_missing))
        else:
            per_id = _per_item_id(items).agg(
                F.sum(F.when(F.col("_t_id").isNull(), F.col("_t_n"))).alias("null_item_ids"),
                F.sum(F.col("_t_n") - 1).alias("duplicate_item_ids"),
                F.sum("_t_blank").alias("missing_item_text"))
            parts.append(_findings_from_counts(per_id, ITEM_CHECKS))
        if "item_id" in interactions.columns and "item_id" in items.columns:
            parts.append(_findings_from_counts(orphan_count(interactions, items), ["interaction_item_join"]))

    findings = reduce(DataFrame.unionByName, parts).where(
        (F.coalesce(F.col("affected_rows"), F.lit(0)) > 0) | (F.col("check") == "required_columns"))
    if ordered:
        findings = findings.orderBy("seq")
    return findings.drop("seq")


def referential_orphans(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Interaction rows whose item is not listed; a null id matches a null id."""
    listed = items.select(F.col("item_id").alias("_listed")).distinct()
    return interactions.join(listed, interactions["item_id"].eqNullSafe(listed["_listed"]), "left_anti")


def orphan_count(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """V9 count: pre-aggregate per item, anti join the listed ids, sum the counts."""
    per_item = interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    listed = items.select(F.col("item_id").alias("_listed")).distinct()
    orphans = per_item.join(listed, per_item["item_id"].eqNullSafe(listed["_listed"]), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("interaction_item_join"))


def validation_report(findings: DataFrame) -> DataFrame:
    """V10 summary: valid iff no error finding; error and warning counts."""
    return findings.agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("is_valid"),
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )


class ValidationError(RuntimeError):
    pass


def gate(findings: DataFrame, report_path: str | None = None) -> DataFrame:
    """Optionally write the report, then fail when any error exists.

    ``report_path`` receives ``summary/`` (is_valid, errors, warnings) and
    ``issues/`` (the findings).  The findings table holds at most one row per
    rule, so it is brought over once and everything else is derived from those
    rows: the validated tables are read a single time.
    """
    spark = findings.sparkSession
    found = spark.createDataFrame(findings.collect(), findings.schema)
    if report_path:
        found.coalesce(1).write.mode("overwrite").json(f"{report_path}/issues")
        validation_report(found).coalesce(1).write.mode("overwrite").json(f"{report_path}/summary")
    if not validation_report(found).first()["is_valid"]:
        raise ValidationError(messages.VALIDATION_FAILED)
    return found
