"""First-seen rows, latest rows, samples, numbers and pages over a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.session import unused

#: Rows a range that the bounds of ranges are taken from.
BOUND_ROWS = 200


def ranked(df: DataFrame, keys: list[str], order: list[str | Column], most: int) -> DataFrame:
    """The first `most` rows of each key. A group is ranked in pieces before the shuffle (window group limit)."""
    rank = unused(df, "rank")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= most).drop(rank)


def first_seen(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Of rows with the same key the one that came first; `order` states how they arrived. Rows with a null key are kept
    apart by their key like any other."""
    return ranked(df, keys, order, 1)


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The values of `columns` in the row with the largest `order` of each key, by partial aggregation alone."""
    picked = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in columns))


def sample_per_group(df: DataFrame, keys: list[str], order: list[str | Column], n: int) -> DataFrame:
    return ranked(df, keys, order, n)


def page(df: DataFrame, order: list[str | Column], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def numbered(df: DataFrame, order: list[str], name: str = "id", ranges: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 over a total order, nulls first, without a task that holds all rows.

    Rows are dealt to ranges between fixed bounds, the quantiles of a sample of the order's columns (BOUND_ROWS a range);
    each range is numbered for itself and starts after the sizes of those before it. The bounds are values, so it does
    not matter how often or in how many partitions Spark computes the rows. `df` must give the same rows each time.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, within = unused(df, "part"), unused(df, "within")
    rows = df.count()
    key = F.struct(*order)
    sample = df.select(*order) if rows <= n * BOUND_ROWS else df.select(*order).sample(n * BOUND_ROWS / rows, seed=1)
    seen = sample.orderBy(*order).limit(2 * n * BOUND_ROWS).collect() if n > 1 else []
    cuts = [seen[len(seen) * i // n] for i in range(1, n)] if seen else []
    kinds = [df.schema[c].dataType for c in order]
    bounds = [F.struct(*(F.lit(v).cast(k).alias(c) for c, v, k in zip(order, row, kinds, strict=True))) for row in dict.fromkeys(cuts)]
    dealt = df.withColumn(part, F.size(F.filter(F.array(*bounds), lambda b: b <= key)) if bounds else F.lit(0))
    sizes = {r[part]: r["count"] for r in dealt.groupBy(part).count().collect()}  # a row a range
    before = {p: sum(v for q, v in sizes.items() if q < p) for p in sizes}
    starts = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else None
    out = dealt.withColumn(within, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    number = F.col(within) + (F.element_at(starts, F.col(part)) if starts is not None else 0)
    return out.withColumn(name, number.cast("long")).drop(part, within)
