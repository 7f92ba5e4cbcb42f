"""Placement of rows on shards through a lookup table filled by preference order.

Each shard has its own permutation of the slots of a prime-sized table. The shards take
turns, and at its turn a shard claims the first slot of its permutation that is still
free, until the table is full. So every shard owns nearly the same number of slots, and
taking a shard out or in moves few slots besides its own. A row finds its shard with one
hash and one look into the table.

Empty and repeated names of shards are refused. Rows with a null key have a slot of their
own, equal keys go to the same shard, an empty table of rows stays empty. Columns of the
input that have the names of the result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import local_frame

# Slots of the table: a prime, some hundred times the number of shards.
TABLE_SIZE = 65_537

# The largest table that may be sent to all executors: 12 bytes a slot, 12 MB.
MOST_SLOTS = 1 << 20


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest())


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The position in ``shards`` of the owner of each slot."""
    if not shards or len(set(shards)) < len(shards) or not all(shards):
        raise ValueError("Shards need names, each used once")
    if not is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"{size} slots: give a prime from the number of shards to {MOST_SLOTS}")
    place = [_number(f"offset:{name}") % size for name in shards]
    step = [_number(f"skip:{name}") % (size - 1) + 1 for name in shards]
    owner = [-1] * size
    free = size
    while free:
        for shard in range(len(shards)):
            at = place[shard]
            while owner[at] >= 0:
                at = (at + step[shard]) % size
            owner[at] = shard
            place[shard] = (at + step[shard]) % size
            free -= 1
            if not free:
                break
    return owner


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """The table as rows (slot, shard)."""
    owners = fill_table(shards, size)
    rows = [(slot, shards[owner]) for slot, owner in enumerate(owners)]
    return local_frame(spark, rows, "slot int, shard string")


def place(
    df: DataFrame,
    shards: Sequence[str],
    key: str,
    size: int = TABLE_SIZE,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """Add the slot and the shard of each row."""
    text = F.col(key).cast("string")
    hashed = F.xxhash64(text.isNull(), F.coalesce(text, F.lit("")))
    lookup = table_frame(df.sparkSession, shards, size).toDF(slot, shard)
    kept = df.drop(*({slot, shard} - {key}))
    placed = kept.withColumn(slot, F.pmod(hashed, F.lit(size)).cast("int"))
    return placed.join(F.broadcast(lookup), slot)


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard. A shard of many rows is split over several tasks and files."""
    df.hint("rebalance", F.col(shard)).write.partitionBy(shard).parquet(path)
