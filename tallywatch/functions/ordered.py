"""Ordered operations that never sort a whole key in one task.

Each helper takes a `bucket` column that never decreases along the order. Rows are sorted only inside one (key, bucket);
a summary with one row per (key, bucket) carries the state across buckets. A key holding a third of the table is then
spread over all its buckets, and the summary a single task sorts has one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _with_slot(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Add `_slot`, the keys and the bucket as one struct.

    A struct is never NULL and equal when its fields are equal or both NULL, so a plain join on it keeps NULL keys and
    still finds the rows where the window has put them: a null-safe join would shuffle and sort them again.
    """
    return df.withColumn("_slot", F.struct(*keys, bucket.alias("_bucket")))


def _slot_window(keys: Sequence[str]) -> WindowSpec:
    """All slots of a key, over a summary with one row per slot."""
    return Window.partitionBy(*[F.col(f"_slot.{k}") for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    measures: Sequence[str],
    bucket: Column,
    with_totals: bool = False,
) -> DataFrame:
    """Replace each measure by its inclusive running total along `order` inside the keys.

    `with_totals` adds `<measure>_total`, the total of the whole key.
    """
    split = _with_slot(df, keys, bucket)
    totals = split.groupBy("_slot").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    whole = _slot_window(keys)
    earlier = whole.orderBy("_slot._bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_slot",
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_carry_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy("_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = split.withColumns({m: F.sum(m).over(inside) for m in measures})
    extra = [f"{m}_total" for m in measures] if with_totals else []
    joined = local.join(carry, "_slot").withColumns({m: F.col(m) + F.col(f"_carry_{m}") for m in measures})
    return joined.select(*df.columns, *extra)


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: dict[str, str], bucket: Column
) -> DataFrame:
    """Add, for each `new: source` pair, the source value of the row before this one along `order` inside the keys."""
    split = _with_slot(df, keys, bucket).withColumn("_row", F.struct(*fields.values()))
    inside = Window.partitionBy("_slot").orderBy(*order)
    local = split.withColumn("_before", F.lag("_row").over(inside))
    last = split.groupBy("_slot").agg(F.max_by("_row", F.struct(*order)).alias("_last"))
    earlier = F.lag("_last").over(_slot_window(keys).orderBy("_slot._bucket"))
    joined = local.join(last.select("_slot", earlier.alias("_carry")), "_slot")
    before = F.coalesce(F.col("_before"), F.col("_carry"))
    return joined.withColumns({new: before[source] for new, source in fields.items()}).select(*df.columns, *fields)


def value_bounds(df: DataFrame, columns: Sequence[str], pieces: int) -> dict[str, list[float]]:
    """At most `pieces - 1` increasing cut points per numeric column, from one pass of Spark's approximate quantiles.

    The cut points only decide which task sorts which values, so their error never reaches a result.
    """
    if pieces < 2:
        return {c: [] for c in columns}
    shares = [i / pieces for i in range(1, pieces)]
    found = df.approxQuantile(list(columns), shares, 1 / (4 * pieces))
    return {c: sorted(set(cuts)) for c, cuts in zip(columns, found)}


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """Number of cut points below the value: a pure function of the value, so it is the same in every stage."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(float(b)) for b in bounds])  # folded to one constant
    whole = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        above = (acc["low"] < acc["high"]) & (F.get(cuts, middle) < value)
        return F.struct(
            F.when(above, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(above | (acc["low"] >= acc["high"]), acc["high"]).otherwise(middle).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, whole, halve, lambda acc: acc["low"])


def exact_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, n: str, quantiles: dict[str, float], bucket: Column
) -> DataFrame:
    """Linearly interpolated quantiles from one row per distinct value and its count, one output column per quantile."""
    cumulated = counts.withColumn("_cum", F.col(n))
    placed = running_totals(cumulated, keys, [F.col(value)], ["_cum"], bucket, with_totals=True)
    picks = []
    for name, q in quantiles.items():
        rank = F.lit(float(q)) * (F.col("_cum_total") - 1)
        picks += [
            F.min(F.when(F.col("_cum") > F.floor(rank), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > F.ceil(rank), F.col(value))).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_part_{name}"),
        ]
    found = placed.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_part_{q}")).alias(q)
            for q in quantiles
        ],
    )
