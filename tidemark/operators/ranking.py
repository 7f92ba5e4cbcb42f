"""Exact ranks and cumulative sums without sorting all rows in one task.

The order column is cut into buckets, a deterministic function of the value; totals per
bucket give the offset of each bucket, and only rows of the same bucket are ever sorted
together. Equal values are merged before the sort, so a value that fills a third of the
table is one row of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hash_key, name
from tidemark.session import materialise, scratch

# Largest number of buckets, and the number of rows one bucket should hold.
MAX_BUCKETS = 8192
ROWS_PER_BUCKET = 500_000

# Characters of the md5 text used for one refinement step (16 ** 3 buckets), and the
# longest prefix tried: what is still large below it can only be copies of one id.
PREFIX = 3
LONGEST_PREFIX = 9

# A cut above every md5 text, and the name of the hash while rows are assigned.
EVERYTHING = "g"
HASH = "_hash"


def value_buckets(df: DataFrame, column: str, bucket: str = "bucket") -> DataFrame:
    """Add a bucket number that rises with ``column``, about equal row counts per bucket.

    The edges come from one sketch aggregate (partial on every task, at most
    ``MAX_BUCKETS`` numbers on the driver). They steer balance only, never results.
    """
    edges = _edges(df, column)
    if not edges:
        return df.withColumn(bucket, F.lit(0.0))
    bucketizer = Bucketizer(
        splits=[-float("inf"), *edges, float("inf")], inputCol=column, outputCol=bucket
    )
    return bucketizer.transform(df)


def _edges(df: DataFrame, column: str) -> list[float]:
    # The wanted ranks as one text literal: thousands of literal columns plan slowly.
    steps = ",".join(str(i / MAX_BUCKETS) for i in range(1, MAX_BUCKETS))
    shares = F.split(F.lit(steps), ",").cast("array<double>")
    row = df.agg(
        F.count(name(column)).alias("n"),
        F.percentile_approx(name(column), shares, 5 * MAX_BUCKETS).alias("edges"),
    ).first()
    wanted = min(MAX_BUCKETS, -(-row["n"] // ROWS_PER_BUCKET))
    if wanted <= 1:
        return []
    stride = max(1, MAX_BUCKETS // wanted)
    return sorted(set(row["edges"][stride - 1 :: stride]))


def running_totals(df: DataFrame, order: str, sums: Sequence[str]) -> DataFrame:
    """Cumulative sums of ``sums`` by ``order`` descending, over rows already distinct in it.

    Adds ``cum_x`` and the overall ``total_x`` for each x of ``sums``. The ``bucket`` column
    of :func:`value_buckets` splits the work.
    """
    totals = df.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums])
    # One row per bucket, so this window sees at most MAX_BUCKETS rows, and the
    # broadcast below has the same bound.
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"above_{c}") for c in sums],
        *[F.sum(c).over(Window.partitionBy()).alias(f"total_{c}") for c in sums],
    )
    inside = (
        Window.partitionBy("bucket")
        .orderBy(F.desc(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.withColumns({f"in_{c}": F.sum(c).over(inside) for c in sums})
        .join(F.broadcast(offsets), "bucket")
        .withColumns({f"cum_{c}": F.col(f"in_{c}") + F.col(f"above_{c}") for c in sums})
        .drop(*[f"in_{c}" for c in sums], *[f"above_{c}" for c in sums])
    )


def positions(df: DataFrame, order: Sequence[Column], column: str) -> DataFrame:
    """Add the position (from 1) of each row in an order without ties.

    Rows are cut into ranges of the order, which are written so that their borders stay;
    each range is sorted by itself and begins behind the rows of those before it.
    """
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = materialise(ranges, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, in the window and in the broadcast.
    offsets = ranges.groupBy("_range").count()
    offsets = offsets.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranges.join(F.broadcast(offsets), "_range").withColumn(column, inside + F.col("_before"))
    return placed.drop("_range", "_before")


def hash_cuts(
    df: DataFrame,
    id_col: str,
    quotas: Callable[[DataFrame], DataFrame],
    *,
    strata: str | None = None,
    salt: str,
) -> DataFrame:
    """Hash keys at which the first ``q`` rows of a stratum end: (stratum, cuts), cuts an array.

    ``quotas`` gets a frame of the strata and their sizes (stratum, n; one stratum, 0, without
    a column) and returns (stratum, n, wanted), ``wanted`` an array of quotas. The row order
    inside a stratum is the md5 of salt and id; copies of an id share it and stay together.
    Counting rows by hash prefix finds the prefix a quota ends in; only rows below that prefix
    are counted again, by a longer prefix, until few are left to sort. Counts, quotas and cuts
    are frames, for any number of strata, and shuffled are counts, never rows. A quota of 0 or
    less has no cut (null); one above the size takes everything. A null stratum is one of its own.
    """
    stratum = name(strata) if strata else F.lit(0)
    keyed = df.select(stratum.alias("stratum"), hash_key(name(id_col), salt).alias("h"))
    with ExitStack() as tables:

        def written(frame: DataFrame) -> DataFrame:
            return tables.enter_context(scratch(frame, "cuts"))

        prefixes = keyed.groupBy("stratum", F.substring("h", 1, PREFIX).alias("p"))
        counts = written(prefixes.agg(F.count("*").alias("n")))
        sizes = counts.groupBy("stratum").agg(F.sum("n").alias("n"))
        wanted = quotas(sizes).select("stratum", "n", F.posexplode("wanted").alias("cut", "wanted"))
        wanted = written(wanted)
        within = wanted.filter("wanted between 1 and n").select("stratum", "cut", F.col("wanted").alias("rank"))
        ends = written(_narrowed(_same_stratum(counts, within)))
        width, last = PREFIX, False
        while not last and (largest := ends.agg(F.max("size")).first()[0]) is not None:
            last = largest <= ROWS_PER_BUCKET or width >= LONGEST_PREFIX
            below = _same_stratum(keyed, ends, F.substring("h", 1, width) == F.col("prefix"))
            width += PREFIX
            part = F.col("h") if last else F.substring("h", 1, width)
            # Copies of one id share their hash and are one row here.
            below = below.groupBy("stratum", "cut", "rank", part.alias("p")).agg(F.count("*").alias("n"))
            ends = written(_narrowed(below))
        ends = ends.select("stratum", "cut", F.col("prefix").alias("end"))
        found = _same_stratum(wanted, ends, F.col("cut") == F.col("own_cut"), how="left", cut="own_cut")
        cut = F.when(F.col("wanted") > F.col("n"), EVERYTHING).otherwise(F.col("end"))
        each = F.sort_array(F.collect_list(F.struct("cut", cut.alias("end"))))
        return materialise(found.groupBy("stratum").agg(each["end"].alias("cuts")), "cuts")


def _same_stratum(
    left: DataFrame, right: DataFrame, also: Column | None = None, how: str = "inner", **renamed: str
) -> DataFrame:
    """Join by stratum, null with null; the planner broadcasts the written side if it is small."""
    right = right.withColumnsRenamed({"stratum": "own_stratum", **renamed})
    same = F.col("stratum").eqNullSafe(F.col("own_stratum"))
    return left.join(right, same if also is None else same & also, how).drop("own_stratum")


def _narrowed(counts: DataFrame) -> DataFrame:
    """The part in which each cut's rank ends, the rank inside it, and its size."""
    upto = F.sum("n").over(
        Window.partitionBy("stratum", "cut").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = counts.withColumn("upto", upto).filter("upto >= rank and upto - n < rank")
    return ends.select(
        "stratum", "cut", F.col("p").alias("prefix"), F.expr("rank - (upto - n)").alias("rank"), F.col("n").alias("size")
    )


def with_hash(df: DataFrame, id_col: str, salt: str) -> DataFrame:
    """Add the hash as a column, so that it is computed once per row."""
    return df.withColumn(HASH, hash_key(name(id_col), salt))


def before_cut(cut: Column) -> Column:
    """Whether a row of :func:`with_hash` comes no later than a cut; a null cut takes none."""
    return F.coalesce(F.col(HASH) <= cut, F.lit(False))
