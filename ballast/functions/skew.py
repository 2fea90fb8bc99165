"""Joins and ordered windows that hold up when one key owns a third of the rows.

Two tools:

* ``lookup_join`` attaches a one-row-per-key side. A side whose size, as
  Catalyst estimates it, lies under the session's broadcast threshold is
  broadcast; otherwise every key, or every key of a given list of hot ones, is
  spread over ``salts`` pieces.
* ``split_hot`` cuts a key with too many rows into ordered segments, at
  sampled places of the whole order (``cuts``), and
  ``carry_rows`` / ``carry_total`` / ``carry_last`` put in front of each segment
  what a window there needs to know of the earlier ones. A window partitioned
  by (keys, SEGMENT) and ordered by (CARRIED first, order) then returns what
  the window over the whole key would return, with no task holding a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.params import SCALE, Scale

SEGMENT = "_segment"
CARRIED = "_carried"


def fits_broadcast(df: DataFrame) -> bool:
    """Does Catalyst's size estimate of ``df`` lie under the session's broadcast threshold?"""
    spark = df.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if threshold.startswith("-"):
        return False
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold)
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    scale: Scale = SCALE,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to the one-row-per-key ``right`` (left, inner or left_semi).

    ``spread`` names left columns that differ within a key; their hash picks
    the salt, so a re-run of a lost task places its rows as before.
    ``hot`` (see `hot_keys`) names the keys to be spread. Without it all are, and ``right`` is shuffled ``salts`` times:
    only for a ``right`` that is small beside ``left``.
    """
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    if hot is not None:
        spread_key = F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))
        names = ", ".join(f"`{c}`" for c in spread)
        absent = " OR ".join(f"`{c}` IS NULL" for c in on)  # rows without a key meet nothing; they are many or few, so spread
        salt = F.expr(f"CASE WHEN _hot OR {absent} THEN CAST(pmod(xxhash64({names}), {scale.salts}) AS INT) ELSE 0 END")
        pieces = F.expr(f"explode(sequence(0, CASE WHEN _hot THEN {scale.salts - 1} ELSE 0 END))")
        salted_left = left.join(spread_key, on, "left").withColumn("_salt", salt).drop("_hot")
        salted_right = right.join(spread_key, on, "left").withColumn("_salt", pieces).drop("_hot")
        return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
    # COALESCE tells Catalyst the salt is never NULL: no extra filter, so equal branches keep sharing exchanges
    names = ", ".join(f"`{c}`" for c in spread)
    salt = F.expr(f"coalesce(CAST(pmod(xxhash64({names}), {scale.salts}) AS INT), 0)")
    salted_left = left.withColumn("_salt", salt)
    salted_right = right.withColumn("_salt", F.expr(f"explode(sequence(0, {scale.salts - 1}))"))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, keys: Sequence[str], scale: Scale = SCALE) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most rows / hot_rows of them."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > F.lit(scale.hot_rows))
        .select(*keys)
    )


def cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Where hot keys are cut: (keys, _cuts, _coarse), sorted places along the whole order.

    A hash picks about ``samples`` rows of every ``hot_rows``; every ``samples``-th of them, in order, is a cut. So there are
    at most about rows / hot_rows cuts in all, however the rows of a key are spread: even at one instant the rest of the
    order tells them apart. A lost task draws the same sample again. _coarse is every ``step``-th cut, see `segment_of`.
    """
    at = F.struct(*order)
    picked = F.pmod(F.xxhash64(*keys, *order), F.lit(scale.hot_rows)) < F.lit(scale.samples)
    drawn = df.filter(picked).join(F.broadcast(hot), list(keys), "left_semi")
    places = drawn.groupBy(*keys).agg(F.sort_array(F.collect_set(at)).alias("_all"))
    every = lambda name, step: F.when(
        F.size(name) >= step, F.transform(F.sequence(step, F.size(name), step), lambda i: F.element_at(name, i.cast("int")))
    ).otherwise(F.filter(F.col(name), lambda x: F.lit(False)))
    places = places.select(*keys, every("_all", F.lit(scale.samples)).alias("_cuts"))
    places = places.withColumn("_step", F.greatest(F.ceil(F.sqrt(F.size("_cuts"))), F.lit(1)).cast("int"))
    return places.select(*keys, "_cuts", "_step", every("_cuts", F.col("_step")).alias("_coarse"))


def segment_of(order: Sequence[str]) -> Column:
    """Number of cuts at or before the row: first among every ``_step``-th, then in the stretch behind the last of these."""
    at = F.struct(*order)
    upto = lambda places: F.size(F.filter(places, lambda x: x <= at))
    start = upto(F.col("_coarse")) * F.col("_step")
    return (start + upto(F.slice("_cuts", start + 1, F.col("_step")))).cast("bigint")


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str], places: DataFrame) -> DataFrame:
    """Add SEGMENT: the number of the stretch between cuts (never falling along the order) for hot keys, 0 for the rest."""
    cut = df.join(F.broadcast(places), list(keys), "left")
    return cut.withColumn(SEGMENT, F.when(F.col("_cuts").isNotNull(), segment_of(order)).otherwise(F.lit(0).cast("bigint"))).select(
        *df.columns, SEGMENT
    )


def _hot_only(df: DataFrame, keys: Sequence[str], order: Sequence[str], places: DataFrame) -> DataFrame:
    return df.join(F.broadcast(places), list(keys), "inner").withColumn(SEGMENT, segment_of(order)).select(*df.columns, SEGMENT)


def segment_window(keys: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*keys, SEGMENT).orderBy(F.col(CARRIED).desc(), *order)


def carry_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, hot: DataFrame, scale: Scale = SCALE
) -> DataFrame:
    """Segment ``df`` and put the ``rows`` rows that precede each segment in front of it.

    Serves LAG and ROWS n PRECEDING frames. Drop the CARRIED rows afterwards.
    """
    places = cuts(df, keys, order, hot, scale)
    columns = df.columns
    tails = (
        _hot_only(df, keys, order, places)
        .withColumn(
            "_from_end",
            F.row_number().over(Window.partitionBy(*keys, SEGMENT).orderBy(*[F.col(o).desc() for o in order])),
        )
        .filter(F.col("_from_end") <= F.lit(rows))
    )
    # at most `rows` rows per segment remain, so a key's tails fit one task
    along = Window.partitionBy(*keys).orderBy(*order)
    carried = (
        tails.withColumn("_before", F.collect_list(F.struct(*columns)).over(along.rowsBetween(-rows, -1)))
        .withColumn("_last_segment", F.lag(SEGMENT).over(along))
        .filter(F.col("_last_segment").isNotNull() & (F.col("_last_segment") != F.col(SEGMENT)))
        .select(F.col(SEGMENT), F.explode("_before").alias("_row"))
        .select("_row.*", SEGMENT, F.lit(True).alias(CARRIED))
    )
    return split_hot(df, keys, order, places).withColumn(CARRIED, F.lit(False)).unionByName(carried)


def carry_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amounts: Sequence[str], hot: DataFrame, scale: Scale = SCALE
) -> DataFrame:
    """Segment ``df``; each segment is preceded by one row holding the earlier segments' totals.

    Serves running sums. Columns other than keys and amounts are NULL in the
    CARRIED rows.
    """
    places = cuts(df, keys, order, hot, scale)
    per_segment = (
        _hot_only(df, keys, order, places).groupBy(*keys, SEGMENT).agg(*[F.sum(a).alias(a) for a in amounts])
    )
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_segment.select(*keys, SEGMENT, *[F.sum(a).over(earlier).alias(a) for a in amounts])
        .filter(F.col(amounts[0]).isNotNull())
        .withColumn(CARRIED, F.lit(True))
    )
    return (
        split_hot(df, keys, order, places)
        .withColumn(CARRIED, F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
    )


def carry_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot: DataFrame, scale: Scale = SCALE
) -> DataFrame:
    """Segment ``df``; each segment is preceded by the last non-NULL ``value`` of the earlier ones.

    Serves LAST(value) IGNORE NULLS, the heart of an as-of join.
    """
    places = cuts(df, keys, order, hot, scale)
    at = F.struct(*order)
    per_segment = (
        _hot_only(df, keys, order, places)
        .groupBy(*keys, SEGMENT)
        .agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), at)).alias(value))
    )
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_segment.select(*keys, SEGMENT, F.last(value, ignorenulls=True).over(earlier).alias(value))
        .filter(F.col(value).isNotNull())
        .withColumn(CARRIED, F.lit(True))
    )
    return (
        split_hot(df, keys, order, places)
        .withColumn(CARRIED, F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
    )
