"""Running totals, row numbers, first/last rows and exact cut-offs without a one-task window.

All of them aggregate before they order: a window only ever sees one small block of rows, and the
totals of the blocks are ordered in two further, much smaller levels.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUPS = 1024
BLOCKS_PER_GROUP = 1024


def _before(window_cols, order):
    return Window.partitionBy(*window_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def whole(value: Column, by) -> Column:
    """Integer division; ids beyond 2^53 must not pass through a double."""
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by))


def _known(number: Column) -> Column:
    """Not null by type. Otherwise every join below adds its own null filter to the input, and the
    three uses of the input no longer share one exchange.
    """
    return F.coalesce(number.cast("bigint"), F.lit(0).cast("bigint"))


def _fixed_blocks(rows: DataFrame, order: str, width: int) -> DataFrame:
    """Blocks of equal width; for orders of known density, like pre-aggregated milliseconds."""
    rows = rows.withColumn("_block", _known(whole(F.col(order), width)))
    return rows.withColumn("_group", _known(whole(F.col("_block"), BLOCKS_PER_GROUP)))


def _numbers(values, kind: str) -> Column:
    """A constant array from one string, which the planner folds; a literal each is slow to build."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _quantile_blocks(rows: DataFrame, order: str) -> DataFrame:
    """Groups between quantiles of `order`, each cut into blocks of equal width.

    Ids of different origin can lie in a few dense spots of a huge range. The quantiles bound a group
    to about a thousandth of the rows wherever they lie; the blocks inside are usually far smaller.
    The quantiles are found by one job over the order column alone; they are at most `GROUPS` numbers.
    As doubles they may be a little off for ids beyond 2^53, which moves a border but no order.
    """
    value = F.col(order).cast("double")
    shares = _numbers([n / GROUPS for n in range(GROUPS + 1)], "double")
    found = rows.agg(F.percentile_approx(value, shares, 4 * GROUPS)).first()[0] or []
    bounds = sorted(set(found)) or [0.0]  # no rows: one border, which parts nothing
    splits = [-float("inf"), *bounds, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_order_value", outputCol="_order_bucket", handleInvalid="keep")
    rows = bucketizer.transform(rows.withColumn("_order_value", value))
    rows = rows.withColumn("_group", _known(F.col("_order_bucket")))
    # by group: where it begins, and the width that cuts it into at most BLOCKS_PER_GROUP blocks
    begins = [int(b) for b in [*bounds[:1], *bounds]] or [0]
    widths = [max(1024, (high - low) // BLOCKS_PER_GROUP + 1) for low, high in zip(begins, [*begins[1:], begins[-1]])]

    def of_group(numbers):
        return F.get(_numbers(numbers, "bigint"), F.col("_group").cast("int"))

    block = whole(F.col(order) - of_group(begins), of_group(widths))
    return rows.withColumn("_block", _known(block)).drop("_order_value", "_order_bucket")


def running_totals(df: DataFrame, order: str, totals: dict[str, str], by=(), width: int | None = None) -> DataFrame:
    """Add exclusive running totals in the order of the integer column `order`, within `by`.

    `totals` maps value column to result column. `order` must be unique within `by` and not null. Blocks follow the
    quantiles of `order`, or have a fixed `width` where its density is known.
    """
    by = list(by)
    rows = _fixed_blocks(df, order, width) if width else _quantile_blocks(df, order)

    blocks = rows.groupBy(*by, "_group", "_block").agg(*[F.sum(v).alias(f"_b_{v}") for v in totals])
    groups = blocks.groupBy(*by, "_group").agg(*[F.sum(f"_b_{v}").alias(f"_g_{v}") for v in totals])

    def shift(prefix, value, window):
        return F.coalesce(F.sum(f"{prefix}{value}").over(window), F.lit(0))

    over_groups, over_blocks = _before(by, "_group"), _before([*by, "_group"], "_block")
    groups = groups.select(*by, "_group", *[shift("_g_", v, over_groups).alias(f"_go_{v}") for v in totals])
    blocks = blocks.join(groups, [*by, "_group"]).select(
        *by,
        "_group",
        "_block",
        *[(F.col(f"_go_{v}") + shift("_b_", v, over_blocks)).alias(f"_bo_{v}") for v in totals],
    )
    place = [*by, "_group", "_block"]
    over_rows = _before(place, order)
    return rows.join(blocks, place).select(
        *df.columns,
        *[(F.col(f"_bo_{v}") + shift("", v, over_rows)).alias(name) for v, name in totals.items()],
    )


def number_rows(df: DataFrame, order: str, name: str, lead: str | None = None) -> DataFrame:
    """0-based row number by `lead` descending (if given), then by the unique integer `order`."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    if lead is None:
        return running_totals(counted, order, {"_one": name}).drop("_one")
    sizes = df.groupBy(lead).agg(F.count("*").alias("_n"))
    # one row per distinct value of `lead`
    over = Window.orderBy(F.desc(lead)).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(lead, F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_start"))
    within = running_totals(counted, order, {"_one": "_within"}, by=[lead])
    return within.join(starts, lead).select(*df.columns, (F.col("_start") + F.col("_within")).alias(name))


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the smallest by `order`. Partial aggregation keeps a hot key cheap."""
    return _extreme(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the largest by `order`."""
    return _extreme(df, keys, order, F.max_by)


def _extreme(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    row, rank = F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(pick(row, rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def with_previous(
    df: DataFrame, keys, order, values, slice_by: Column, name: str = "previous"
) -> DataFrame:
    """Add the struct of `values` of the row before, per key in the order of `order`.

    `slice_by` is a non-decreasing function of the first order column. Rows are ordered inside one
    slice of a key; between slices only the last row of each travels, so one hot key still spreads
    over as many tasks as it has slices. Null keys are one key, and rows without an order come first.
    """
    rows = df.withColumn("_slice", slice_by).withColumn("_value", F.struct(*[F.col(c) for c in values]))
    # one struct as the key, as its equality holds for nulls inside
    rows = rows.withColumn("_place", F.struct(*keys, "_slice"))
    lasts = rows.groupBy("_place").agg(
        F.max_by("_value", F.struct(*[F.col(c) for c in order])).alias("_last")
    )
    by_slice = Window.partitionBy(*[F.col(f"_place.`{c}`") for c in keys]).orderBy("_place._slice")
    carried = lasts.select("_place", F.lag("_last").over(by_slice).alias("_carried"))
    inside = Window.partitionBy("_place").orderBy(*order)
    previous = F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(
        F.lag("_value").over(inside)
    )
    return rows.join(carried, "_place").select(*df.columns, previous.alias(name))


def shuffle_key(row_id: Column, seed: int = 0) -> Column:
    """Stable pseudo-random order key: the same on every run, worker and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")))


def shuffle_number(row_id: Column, seed: int = 0) -> Column:
    """The first 60 bits of `shuffle_key` as a number, in the same order."""
    return F.conv(F.substring(shuffle_key(row_id, seed), 1, 15), 16, 10).cast("bigint")


def cutoff(keys: DataFrame, rank, key: str = "key") -> Column:
    """Scalar subquery: the `rank`-th smallest hexadecimal key, null when rank is 0.

    Keys are counted by their first four digits; only the one bucket the rank falls into is ordered.
    `rank` is a function of the total row count (a Column) or a number.
    """
    prefix = F.substring(key, 1, 4)
    counts = keys.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"))
    # at most 65,536 rows
    running = counts.select(
        "prefix",
        "n",
        F.sum("n").over(Window.orderBy("prefix")).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    wanted = rank(F.col("total")) if callable(rank) else F.lit(rank)
    hit = running.withColumn("wanted", wanted).filter("wanted > upto - n and wanted <= upto")
    place = (F.col("wanted") - F.col("upto") + F.col("n")).alias("place")
    found = hit.agg(F.max(F.struct("prefix", place)).alias("hit")).scalar()
    # the bucket is picked by a filter, so the other keys never travel
    inside = keys.select(key, prefix.alias("prefix")).filter(F.col("prefix") == found["prefix"])
    ranked = inside.withColumn("rn", F.row_number().over(Window.partitionBy("prefix").orderBy(key)))
    return ranked.filter(F.col("rn") == found["place"]).agg(F.max(key).alias("cut")).scalar()


def top_by_count(counts: DataFrame, limit: int, count: str = "n", tie: str = "token") -> DataFrame:
    """The `limit` rows with the largest count, ties by `tie`, with a 1-based `rank`.

    A histogram of the counts gives the smallest count that can still be in, so that the final
    ordering sees little more than `limit` rows.
    """
    shape = counts.groupBy(count).agg(F.count("*").alias("_rows"))
    above = F.sum("_rows").over(Window.orderBy(F.desc(count)).rowsBetween(Window.unboundedPreceding, -1))
    least = (
        shape.withColumn("_above", F.coalesce(above, F.lit(0)))
        .filter(F.col("_above") < limit)
        .agg(F.min(count).alias("least"))
        .scalar()
    )
    order = [F.desc(count), F.asc(tie)]
    top = counts.filter(F.col(count) >= least).orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
