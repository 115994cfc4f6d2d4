"""Retry: find incomplete rows in the logs, decide on patches, patch the match table, log it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline import schemas
from touchline.functions.text import is_blank, null_to_blank, strip, to_int
from touchline.operators.keys import first_per_key, last_per_key
from touchline.operators.status import KEPT_ON_FAILURE, error_text, logged_reason
from touchline.sources.tables import conform


def plain_reason(reason: Column) -> Column:
    return F.lower(strip(null_to_blank(reason)))


def needs_retry(reason: Column, fields: Column, threshold: int = fv.RETRY_THRESHOLD) -> Column:
    """A retryable reason, or fewer fields than the threshold; a count that is no whole number never is."""
    low = F.coalesce(to_int(fields.cast("string")) < threshold, F.lit(False))
    return plain_reason(reason).isin(fv.RETRY_REASONS) | low


def retry_trigger(reason: Column) -> Column:
    return F.when(plain_reason(reason).isin(fv.RETRY_REASONS), plain_reason(reason)).otherwise("low_fields")


def candidates(
    logs: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = ("url",),
    threshold: int = fv.RETRY_THRESHOLD,
) -> DataFrame:
    """Log rows to retry: the first qualifying row per key, with its trigger.

    Rows are filtered before they are shuffled, and URLs are stripped. ``order`` must be unique within a key.
    """
    found = logs.where(needs_retry(F.col("reason"), F.col("non_empty_fields"), threshold))
    found = found.withColumn("url", strip(F.col("url"))) if "url" in logs.columns else found
    return first_per_key(found, keys, order).withColumn("retry_trigger", retry_trigger(F.col("reason")))


def patch_decision(has_data: Column, fields_before: Column, fields_after: Column, match_id: Column) -> Column:
    """New data with more fields than before (a count that is no number is 0) and a match id."""
    before = F.coalesce(to_int(fields_before.cast("string")), F.lit(0))
    return F.coalesce(has_data & (fields_after > before) & ~is_blank(match_id), F.lit(False))


def patches_to_apply(
    patches: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "last"
) -> DataFrame:
    """One qualifying patch per key: the last in order, or the one with most fields, earliest on ties."""
    if keep == "best":
        first = [(-F.col("fields_after")), *order]
        return first_per_key(patches, keys, first)
    if keep != "last":
        raise ValueError("keep is 'last' or 'best'")
    return last_per_key(patches, keys, order)


def patch_rows(
    base: DataFrame,
    patches: DataFrame,
    keys: Sequence[str],
    line: str,
    columns: Sequence[str],
    merge: str = "replace",
    flag: str = "patched",
) -> DataFrame:
    """The base with the first row of each patched key replaced, and a flag column.

    ``patches`` has one row per key, with the key and any of ``columns``. With the file's stem in the
    key a patch reaches its own file only. The default replaces all of ``columns``, with '' where the
    patch has none; ``merge="coalesce"`` keeps the old value there. Other rows stay as they are, keys
    that the base lacks are not inserted, and a blank key is never patched.

    Only rows with a patched key are looked at for the smallest ``line``. The base itself joins on
    (key, line), which is spread evenly even if one key holds most rows.
    """
    if merge not in ("replace", "coalesce"):
        raise ValueError("merge is 'replace' or 'coalesce'")
    absent = [c for c in columns if c not in patches.columns]
    new = patches.select(
        *keys,
        F.struct(
            *[(F.lit("") if c in absent else null_to_blank(F.col(c).cast("string"))).alias(c) for c in columns]
        ).alias("_new"),
    )
    known = reduce(lambda a, b: a & b, [~is_blank(F.col(k).cast("string")) for k in keys])
    first_lines = base.where(known).join(new.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(F.min(line).alias(line))
    targets = first_lines.join(new, list(keys))
    joined = base.join(targets, [*keys, line], "left")
    old = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    if merge == "coalesce":
        value = F.struct(
            *[
                F.when(is_blank(F.col(f"_new.{c}")), F.col(c).cast("string")).otherwise(F.col(f"_new.{c}")).alias(c)
                for c in columns
            ]
        )
    else:
        value = F.col("_new")
    is_patched = F.col("_new").isNotNull()
    rest = [c for c in base.columns if c not in columns]
    picked = joined.select(*rest, F.when(is_patched, value).otherwise(old).alias("_row"), is_patched.alias(flag))
    return picked.select(
        *[F.col(f"_row.{c}").alias(c) if c in columns else F.col(c) for c in base.columns], flag
    )


def with_data_flag(
    logs: DataFrame, data: DataFrame, stem: str = "stem", flag: str = "data_csv_found"
) -> DataFrame:
    """Log rows with a flag for whether a data file of the same stem exists."""
    stems = data.select(stem).distinct().withColumn("_found", F.lit(True))
    return logs.join(stems, stem, "left").select(
        *logs.columns, F.coalesce(F.col("_found"), F.lit(False)).alias(flag)
    )


def retry_log(retried: DataFrame, known_ids: DataFrame, keys: Sequence[str] = ("stem", "match_id")) -> DataFrame:
    """Retry log rows.

    ``retried`` holds one row per retry: the log columns of the new run, ``status``, ``has_data``,
    ``fields_before``, ``fields_after``, the keys, ``retry_trigger``, ``file_name`` and
    ``data_csv_found``. A row is updated when the decision says so and the data file is there and has
    the id. A row with an ``error`` is an exception row: it is no success, the cut text is its reason, and what the new run
    would have counted is NULL.
    """
    ids = known_ids.select(*keys).distinct().withColumn("_known", F.lit(True))
    failed = F.col("error").isNotNull() if "error" in retried.columns else F.lit(False)
    reason = F.when(failed, error_text(F.col("error"))) if "error" in retried.columns else F.when(F.lit(False), F.lit(""))
    decided = patch_decision(
        F.col("has_data"), F.col("fields_before"), F.col("fields_after"), F.col("match_id").cast("string")
    )
    rows = (
        retried.join(ids, list(keys), "left")
        .withColumn("row_updated", ~failed & decided & F.col("data_csv_found") & F.coalesce(F.col("_known"), F.lit(False)))
        .withColumn("success", ~failed & is_blank(F.col("status")))
        .withColumn("reason", F.when(failed, reason).otherwise(logged_reason(F.col("status"))))
        .withColumn("fields_after", F.when(~failed, F.col("fields_after")))
        .withColumn("non_empty_fields", F.col("fields_after"))
        .withColumn("fields_before", to_int(F.col("fields_before").cast("string")))
    )
    measured = [c for c, kind in fv.LOG_COLUMNS if kind == "double" and c not in KEPT_ON_FAILURE and c in rows.columns]
    return conform(rows.withColumns({c: F.when(~failed, F.col(c)) for c in measured}) if measured else rows, schemas.RETRY_LOG)
