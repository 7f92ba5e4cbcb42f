"""Repeatable samples of a fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import HASH, before_cut, hash_cuts, with_hash


def sample_fixed(df: DataFrame, id_col: str, n: int, *, salt: str = "sample:") -> DataFrame:
    """``n`` rows without replacement: the first by md5 of salt and id.

    The cut is found from counts, and the sample itself is a filter: no sort and no
    shuffle of rows, whatever ``n`` is. Ids are taken to be unique; copies of an id stay
    together.
    """
    wanted = F.array(F.lit(n).cast("long")).alias("wanted")
    row = hash_cuts(df, id_col, lambda sizes: sizes.select("stratum", "n", wanted), salt=salt).first()
    cut = F.lit(row["cuts"][0] if row else None).cast("string")
    return with_hash(df, id_col, salt).filter(before_cut(cut)).drop(HASH)
