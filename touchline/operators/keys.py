"""Per-key operators that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import written


def range_bands(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int, name: str = "band") -> DataFrame:
    """The rows with a band column that cuts them into ``parts`` even stretches along (keys, order).

    For keys without a natural band: stretches follow the rows' real distribution, so a hot key gets
    as many as it needs. The ranged rows are written once, since bands must not change between reads.
    """
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn(name, F.spark_partition_id())
    return written(ranged, "bands")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet, so that rows without a key are not lost; left keys are kept."""
    renamed = right.select([F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be unique within a key.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a hot key
    costs one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return first.select([F.col("_row")[c].alias(c) for c in df.columns])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key; see ``first_per_key``."""
    row = F.struct(*[F.col(c) for c in df.columns])
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return last.select([F.col("_row")[c].alias(c) for c in df.columns])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    name: str,
    band: Column,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Running total of ``value`` per key, the row itself included.

    ``band`` cuts a key into consecutive stretches: it must not fall along ``order``. Rows are
    summed within (key, band); the total of earlier bands, one row per band, is added. A task
    never holds more than one band of a key. ``offsets`` (the keys and ``offset``) holds a start for
    each key; it joins the band sums, not the rows.

    Rows are shuffled once: the window and the join of the starts go by the same struct of key and band, in
    which NULLs are equal, so the join finds them where the window has left them.
    """
    banded = df.select("*", F.struct(*[F.col(k) for k in keys], band.alias("_band")).alias("_at"), value.alias("_value"))
    within = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("decimal(38,6)"))
    bands = (
        banded.groupBy("_at")
        .agg(F.sum("_value").cast("decimal(38,6)").alias("_sum"))
        .select("_at", "_at.*", "_sum")
        .select("_at", *keys, start.alias("_start"))
    )
    if offsets is not None:
        bands = join_on(bands, offsets, keys).withColumn("_start", (F.col("_start") + F.col("offset")).cast("decimal(38,6)"))
    rows = banded.withColumn("_within", F.sum("_value").over(within).cast("decimal(38,6)"))
    return rows.join(bands.select("_at", "_start"), "_at").select(
        *df.columns, (F.col("_start") + F.col("_within")).cast("decimal(38,6)").alias(name)
    )


def totals_before(totals: DataFrame, key: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """For each row of a one-row-per-key table: the sum of ``value`` over all smaller keys.

    Keys are ranged into ``parts`` consecutive parts, as many as the session shuffles to by default. The ranged table is written once, since the
    part of a key must not change between the two reads. Only the part sums, at most ``parts``
    rows, go through one window and are broadcast.
    """
    parts = parts or int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        totals.select(key, value)
        .repartitionByRange(parts, key)
        .withColumn("_part", F.spark_partition_id()),
        "ranged-totals",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,6)")
    parts_before = (
        ranged.groupBy("_part")
        .agg(F.sum(value).cast("decimal(38,6)").alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), zero).alias("_part_start"))
    )
    within = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_within", F.coalesce(F.sum(value).over(within).cast("decimal(38,6)"), zero))
    return rows.join(F.broadcast(parts_before), "_part").select(
        key, (F.col("_part_start") + F.col("_within")).cast("decimal(38,6)").alias(name)
    )


def rolling_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    measures: dict[str, Column],
    band: Column,
) -> DataFrame:
    """Measures over the ``rows`` rows before each row of its key, the row itself left out.

    ``measures`` maps a name to an aggregate column. ``band`` cuts a key into consecutive stretches
    along ``order``. Each band is computed on its own after the last ``rows`` rows of the key before
    it are put in front of it, so a hot key is spread over as many tasks as it has bands.
    """
    columns = df.columns
    banded = df.withColumn("_band", band)
    latest = [F.col(c).desc() for c in order]
    recent = Window.partitionBy(*keys, "_band").orderBy(*latest)
    row = F.struct(*[F.col(c) for c in columns])
    sort_key = F.struct(*[F.col(c) for c in order])
    tails = (
        banded.withColumn("_n", F.row_number().over(recent))
        .where(F.col("_n") <= rows)
        .groupBy(*keys, "_band")
        .agg(F.sort_array(F.collect_list(F.struct(sort_key.alias("k"), row.alias("r")))).alias("_tail"))
    )
    # Every band holds a row, so the last `rows` rows lie in at most `rows` earlier bands.
    earlier = Window.partitionBy(*keys).orderBy("_band").rowsBetween(-rows, -1)
    carried = (
        tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(earlier)))
        .where(F.size("_all") > 0)
        .select("_band", F.explode(F.slice("_all", -F.least(F.lit(rows), F.size("_all")), rows)).alias("_old"))
        .select("_band", "_old.r.*")
        .select(*columns, "_band", F.lit(True).alias("_carried"))
    )
    everything = banded.select(*columns, "_band", F.lit(False).alias("_carried")).unionByName(carried)
    before = Window.partitionBy(*keys, "_band").orderBy(*order).rowsBetween(-rows, -1)
    return (
        everything.select("*", *[m.over(before).alias(n) for n, m in measures.items()])
        .where(~F.col("_carried"))
        .drop("_band", "_carried")
    )
