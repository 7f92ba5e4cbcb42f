"""Batches of texts of similar length, with the least padding for a number of buckets.

The lengths of all rows are counted in one histogram. Dynamic programming over it finds
the bucket boundaries for which padding every row to the longest of its bucket costs
least. Inside a bucket the rows are numbered, and as many as the token budget allows at
the bucket's width make a batch.

A null or empty text has length 0; rows of equal length share a bucket; a row wider than
the budget is a batch of its own (``over_budget``); an empty table gives no batches. Rows
are numbered by a hash of id and text, so a rerun gives the same batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, word_count
from tidemark.session import materialise

# Lengths are counted exactly up to 12 bits; longer ones share a bin with those that have
# the same 12 leading bits. So a histogram has at most 2**11 bins per doubling: its size
# does not depend on the number of rows.
LEADING_BITS = 12
ROWS_PER_BLOCK = 16_384


def length_bin(length: Column) -> Column:
    """The length without what is behind its leading bits."""
    shift = F.greatest(F.length(F.bin(length)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", length, shift), shift)


def best_boundaries(bins: Sequence[tuple[int, int, int]], buckets: int) -> list[int]:
    """Widths of at most ``buckets`` buckets with the least padding.

    ``bins`` has (longest, number of rows, sum of lengths), ascending. With N and S as the
    running number and sum, a bucket from i to j pads width[j] * (N[j] - N[i]) - (S[j] - S[i]).
    For a fixed i that is a line in width[j], so the best i for ascending j is on the
    lower hull of the lines: each added bucket takes time linear in the bins.
    """
    if not bins:
        return []
    total, length = [0], [0]
    for _, n, s in bins:
        total.append(total[-1] + n)
        length.append(length[-1] + s)
    size = len(bins)
    cost: list[int | None] = [0] + [None] * size
    steps = []
    for _ in range(min(buckets, size)):
        # A line for each i: slope -N[i], intercept cost[i] + S[i].
        hull: list[tuple[int, int, int]] = []
        head, after, origin = 0, [None] * (size + 1), [0] * (size + 1)
        for j in range(1, size + 1):
            if cost[j - 1] is not None:
                line = (-total[j - 1], cost[j - 1] + length[j - 1], j - 1)
                while len(hull) - head >= 2 and _hidden(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            if len(hull) <= head:
                continue
            x = bins[j - 1][0]
            while len(hull) - head >= 2 and _at(hull[head + 1], x) < _at(hull[head], x):
                head += 1
            after[j] = _at(hull[head], x) + x * total[j] - length[j]
            origin[j] = hull[head][2]
        steps.append((after, origin))
        cost = after
    # Fewer buckets win a tie.
    chosen = min(range(len(steps)), key=lambda k: (steps[k][0][size] is None, steps[k][0][size], k))
    widths, at = [], size
    for k in range(chosen, -1, -1):
        widths.append(bins[at - 1][0])
        at = steps[k][1][at]
    return widths[::-1]


def _at(line: tuple[int, int, int], x: int) -> int:
    return line[0] * x + line[1]


def _hidden(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b is nowhere below both a and c (slopes descend)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def histogram(df: DataFrame, length: str) -> list[tuple[int, int, int]]:
    """(longest, rows, sum) per bin of lengths; see LEADING_BITS for its size."""
    counted = df.groupBy(length_bin(F.col(length)).alias("bin")).agg(
        F.max(length).alias("longest"), F.count("*").alias("n"), F.sum(length).alias("total")
    )
    return sorted((r["longest"], r["n"], r["total"]) for r in counted.collect())


def pack(
    df: DataFrame,
    buckets: int = 16,
    token_budget: int = 16_384,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Bucket, batch and position of each row.

    Columns: the id, n_words, bucket (from 0), width, batch (from 0 in each bucket), place
    (in the batch), padding (words added), over_budget.
    """
    rows = df.select(
        F.col(doc_id).alias(doc_id),
        word_count(F.col(text)).alias("n_words"),
        F.xxhash64(row_key(doc_id, text)).alias("_key"),
    )
    rows = materialise(rows, "lengths")
    counts = histogram(rows, "n_words")
    widths = best_boundaries(counts, buckets)
    blocks = sum(n for _, n, _ in counts) // ROWS_PER_BLOCK + 1
    bounds = F.array(*[F.lit(w).cast("long") for w in widths]) if widths else F.array(F.lit(0).cast("long"))
    rows = rows.withColumns({
        "bucket": F.size(F.filter(bounds, lambda w: w < F.col("n_words"))),
        "_block": F.pmod(F.col("_key"), F.lit(blocks)).cast("int"),
    })
    rows = rows.withColumn("width", F.element_at(bounds, F.col("bucket") + 1))
    # A row's number is that in its block, plus the rows of the bucket's blocks before it.
    ahead = Window.partitionBy("bucket").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket", "_block").agg(F.count("*").alias("_n"))
    offsets = offsets.select("bucket", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("bucket", "_block").orderBy("_key", doc_id)
    numbered = rows.withColumn("_row", F.row_number().over(inside) - 1).join(offsets, ["bucket", "_block"])
    at = F.col("_ahead") + F.col("_row")
    per_batch = F.greatest(F.floor(F.lit(token_budget) / F.greatest("width", F.lit(1))), F.lit(1))
    return numbered.select(
        doc_id,
        "n_words",
        "bucket",
        "width",
        F.floor(at / per_batch).cast("long").alias("batch"),
        F.pmod(at, per_batch).cast("int").alias("place"),
        (F.col("width") - F.col("n_words")).alias("padding"),
        (F.col("width") > token_budget).alias("over_budget"),
    )
