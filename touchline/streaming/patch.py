"""Patches as logs arrive.

A micro-batch adds its qualifying patches to a patch table; the match table is not rewritten for
each batch. Reading applies, per id, the patch that wins over all batches, so the result is that of
one batch job over the same input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.retry import patch_rows, patches_to_apply
from touchline.streaming.ingest import per_batch, write_batch


def patch_stream(
    arriving: DataFrame, qualifying: Callable[[DataFrame], DataFrame], patches: str, checkpoint: str
) -> StreamingQuery:
    """Add the qualifying patches among the arriving rows to the patch table."""
    return per_batch(arriving, lambda rows, batch_id: write_batch(qualifying(rows), patches, batch_id), checkpoint)


def patched_view(
    spark: SparkSession,
    base: DataFrame,
    patches: str,
    schema: T.StructType,
    keys: Sequence[str],
    line: str,
    columns: Sequence[str],
    order: Sequence[Column],
    keep: str = "last",
    merge: str = "replace",
) -> DataFrame:
    """The base table under the patches saved so far."""
    saved = spark.read.schema(schema).parquet(patches)
    return patch_rows(base, patches_to_apply(saved, keys, order, keep), keys, line, columns, merge)
