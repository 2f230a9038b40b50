"""Joins and numbering that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are fewer than
# HOT_SHARE hot keys whatever the size of the table: that bounds the broadcast below.
HOT_SHARE = 1000
# Below this many rows a key is never worth splitting.
HOT_ROWS = 50_000
# Rows of a hot key that share a partition; the number of parts follows from the key's count.
SALT_ROWS = 200_000
# Rows of the table that share a slice of ``positions``, as long as there are few enough slices.
SLICE_ROWS = 500_000
MAX_SLICES = 5_000


def hot_keys(
    rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, known_rows: int | None = None
) -> DataFrame | None:
    """Keys with more than ``rows / HOT_SHARE`` rows: fewer than ``HOT_SHARE`` of them.

    Each comes with ``_salts``, the number of parts its rows are dealt into. Counted up
    front in a job of its own (it reads only the key columns), so that the plan of ``rows``
    is not repeated inside the plan of the join. None if there are none.
    """
    total = rows.count() if known_rows is None else known_rows
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _listed(counts, keys, "_n", total, hot_rows)


def _listed(
    counts: DataFrame, keys: Sequence[str], counted: str, total: int, hot_rows: int
) -> DataFrame | None:
    """The hot ones among counted keys, fewer than ``HOT_SHARE``, with ``_salts``."""
    if total <= hot_rows:
        return None
    n = F.col(counted)
    found = counts.where(n > max(hot_rows, total // HOT_SHARE)).select(
        *keys, F.greatest(F.lit(2), F.ceil(n / SALT_ROWS)).cast("int").alias("_salts")
    )
    listed = found.collect()
    return counts.sparkSession.createDataFrame(listed, found.schema) if listed else None


def lookup(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    known_rows: int | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Join many ``rows`` to ``keyed`` (few rows per key) without a hot task.

    Rows of hot keys are dealt over as many parts as their count asks for, and rows with a
    null key over as many as there are partitions, by a hash of the ``spread`` columns; the
    hot rows of ``keyed`` are repeated once per part. The salt is a function of stored
    columns, so a task that runs again after an executor was lost sends its rows to the
    same place. When ``keyed`` is small Spark still turns the join into a broadcast by its
    own size check. Without hot keys this is a plain join. ``known_rows`` saves counting
    rows the caller has counted; ``counted`` names a column of ``keyed`` with the number of
    ``rows`` of its key, where the caller has that too, and is dropped.
    """
    keys = list(keys)
    if counted is None:
        hot = hot_keys(rows.select(*keys), keys, hot_rows, known_rows)
    else:
        total = rows.count() if known_rows is None else known_rows
        hot = _listed(keyed, keys, counted, total, hot_rows)
        keyed = keyed.drop(counted)
    if hot is None:
        return rows.join(keyed, keys, how)
    hot = F.broadcast(hot)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    scattered = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = F.coalesce("_salts", F.when(missing, F.lit(scattered)).otherwise(F.lit(1)))
    salted = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), parts).cast("int"))
    repeated = keyed.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    joined = salted.drop("_salts").join(repeated.drop("_salts"), [*keys, "_salt"], how)
    return joined.drop("_salt")


def meet(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join in which a key may have many rows on both sides.

    A key that is hot on a side is dealt into parts there by a hash of that side's spread
    columns, and the other side's rows of the key are repeated once per part; a key that is
    hot on both sides becomes a grid of parts. Both sides should be stored tables.
    """
    keys = list(keys)

    def dealt(df: DataFrame, spread: Sequence[str], own: str, other: str) -> DataFrame:
        salt = F.pmod(F.xxhash64(*spread), F.col(own)).cast("int")
        return df.withColumn(f"{own}_at", salt).withColumn(
            f"{other}_at", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        ).drop(own, other)

    sides = [left, right]
    for name, source in (("_left", left), ("_right", right)):
        hot = hot_keys(source.select(*keys), keys, hot_rows)
        for i, side in enumerate(sides):
            if hot is None:
                sides[i] = side.withColumn(name, F.lit(1))
            else:
                parts = F.broadcast(hot.withColumnRenamed("_salts", name))
                sides[i] = side.join(parts, keys, "left").withColumn(name, F.coalesce(name, F.lit(1)))
    one = dealt(sides[0], left_spread, "_left", "_right")
    two = dealt(sides[1], right_spread, "_right", "_left")
    return one.join(two, [*keys, "_left_at", "_right_at"]).drop("_left_at", "_right_at")


def sliced(rows: DataFrame, order: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``rows`` with ``_slice``: numbers that rise with ``order``, about ``slice_rows`` rows each."""
    leading = order
    while isinstance(kind := rows.select(leading).schema[0].dataType, StructType):
        leading = f"{leading}.{kind[0].name}"
    at = F.col(leading).cast("double")
    slices = min(MAX_SLICES, -(-rows.count() // slice_rows))
    cuts: list[float] = []
    if slices > 1:
        shares = [i / slices for i in range(1, slices)]
        cuts = sorted(set(rows.select(at.alias("at")).approxQuantile("at", shares, 0.2 / slices)))
    if not cuts:
        return rows.withColumn("_slice", F.lit(0.0))
    bounds = [float("-inf"), *cuts, float("inf")]
    cut = Bucketizer(splits=bounds, inputCol="_at", outputCol="_slice", handleInvalid="keep")
    return cut.transform(rows.withColumn("_at", at)).drop("_at")


def positions(
    rows: DataFrame,
    order: str,
    group: Sequence[str] = (),
    name: str = "pos",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """1-based position of each row inside its group, ordered by ``order``.

    A plain ``row_number`` sorts a whole group in one task. Here the table is cut into
    slices of about ``slice_rows`` rows in the order; a row's position is the number of
    rows in earlier slices of its group plus its rank inside its own slice. The cuts are
    approximate quantiles of the rows, wherever their ids lie; where exactly they fall
    changes the work of a task and not the result. A struct is cut by its first field.
    """
    group = list(group)
    cut = sliced(rows, order, slice_rows)
    before = Window.orderBy("_slice")
    if group:
        before = before.partitionBy(*group)
    starts = (
        cut.groupBy(*group, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *group,
            "_slice",
            (F.sum("_n").over(before) - F.col("_n")).alias("_start"),
        )
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(order)
    ranked = cut.withColumn("_rank", F.row_number().over(inside))
    # null-safe, so that rows of a null group keep their place in the result
    starts = starts.select(*[F.col(c).alias(f"_of_{c}") for c in [*group, "_slice"]], "_start")
    same = F.lit(True)
    for column in [*group, "_slice"]:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    return ranked.join(starts, same).select(
        *rows.columns, (F.col("_start") + F.col("_rank")).cast("bigint").alias(name)
    )


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a one-element ``transform``)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
