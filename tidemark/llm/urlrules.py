"""Verdicts on urls by host and path rules, as a sort-merge range join.

A host is turned around label by label, each label closed by a dot: ``m.example.net`` has
the key ``net.example.m.``. A rule on a host and its subdomains is then the interval of
the keys that its own key begins, and intervals are nested or apart. Urls and rules are
dealt to ranges of keys, a rule to each range that it meets, and sorted. One sweep over a
range keeps the rules open at the current key on a stack, outermost first, so a url sees
those on its host and above only; their paths decide. Range bounds come from a sample of
the urls and have a hash behind the key, so urls of one host may lie in many ranges. They
steer balance only.

The host is what lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the
end, A to Z in lower case; the path goes on to the next ``?``, ``#`` or the end. A null url
and one without ``://`` have an empty host and path. A rule fits a url if the url's host is
the rule's or below it, and the url's path begins with the rule's. Of the rules that fit,
the longest decides (characters of host and path), of equally long ones that with the
longer host. Without one the verdict is the default and the rule null.

A rule with an empty host fits every host. A null host or path is empty; a rule with a
null verdict is none. Of rules with equal host and path, the greatest verdict counts (block
before allow). Every url row is judged once, rows that repeat an id or have a null id too.
Only the id and the url are read, so further columns of any name do no harm. Empty tables
give no rows; without rules every verdict is the default.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Urls of one range, as far as the number of ranges goes; a sweep holds a batch and its stack only.
URLS_PER_RANGE = 250_000
RANGES = 16_384
SAMPLED_PER_RANGE = 20
# Characters of a key that range bounds look at.
BOUND_CHARS = 256

LOWEST, HIGHEST = -(2**63), 2**63 - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Bounds = list[tuple[str, int]]


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot; all hosts below share the beginning."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def range_of(bounds: Bounds, key: str, salt: int) -> int:
    """The range of a url."""
    return bisect_right(bounds, (key[:BOUND_CHARS], salt))


def ranges_of(bounds: Bounds, key: str) -> tuple[int, int]:
    """The first and last range that can hold a url whose key begins with a rule's."""
    if not key:
        return 0, len(bounds)
    start = key[:BOUND_CHARS]
    first = bisect_right(bounds, (start, LOWEST))
    if len(key) > BOUND_CHARS:
        return first, bisect_right(bounds, (start, HIGHEST))
    # "/" follows "." in the order of characters, so this is behind all keys with this beginning.
    return first, bisect_left(bounds, (key[:-1] + "/", LOWEST))


class Sweep:
    """The rules open at the current key of a sorted run of rules and urls."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, str], list[int]]] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, verdict: str) -> None:
        self._close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        paths[path] = max(verdict, paths.get(path, verdict))
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def longest(self, key: str, path: str) -> tuple[str, str, str] | None:
        """Key, path and verdict of the rule that decides."""
        self._close(key)
        found = None
        for own, paths, lengths in self.stack:
            for n in lengths:
                if n <= len(path) and path[:n] in paths:
                    size = (len(own) + n, len(own))
                    if found is None or size > found[0]:
                        found = size, (own, path[:n], paths[path[:n]])
                    break
        return found and found[1]


def judge(
    df: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule (as host and path) and verdict of every row.

    ``rules`` has the columns host, path and verdict.
    """
    spark = df.sparkSession
    host, path = host_and_path(url)
    parts = df.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = parts.select("*", host_key(F.col("host")).alias("key"), F.xxhash64("page_id", "host", "path").alias("salt"))
    rows = urls.count()
    n = min(RANGES, max(-(-rows // URLS_PER_RANGE), spark.sparkContext.defaultParallelism))
    share = min(1.0, n * SAMPLED_PER_RANGE / max(rows, 1))
    seen = urls.sample(share, seed=1).select(F.substring("key", 1, BOUND_CHARS).alias("key"), "salt").collect()
    seen = sorted((r["key"], r["salt"]) for r in seen)
    bounds: Bounds = sorted({seen[len(seen) * i // n] for i in range(1, n)}) if seen else []

    own_host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    given = rules.where(F.col("verdict").isNotNull()).select(
        F.when(own_host == "", "").otherwise(host_key(own_host)).alias("key"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.col("verdict").cast("string").alias("verdict"),
    )

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts = batch.column("key").to_pylist(), batch.column("salt").to_pylist()
            own = [range_of(bounds, k, s) for k, s in zip(keys, salts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], [*batch.schema.names, "range"])

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [ranges_of(bounds, k) for k in batch.column("key").to_pylist()]
            first, last = (pa.array([e[i] for e in ends], pa.int32()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, first, last], [*batch.schema.names, "first", "last"])

    placed = urls.mapInArrow(place_urls, StructType([*urls.schema.fields, StructField("range", IntegerType())]))
    met = given.mapInArrow(
        place_rules,
        StructType([*given.schema.fields, StructField("first", IntegerType()), StructField("last", IntegerType())]),
    )
    met = met.withColumn("range", F.explode(F.sequence("first", "last")))
    both = placed.select("range", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    both = both.unionByName(met.select("range", "key", F.lit(0).alias("kind"), "path", "verdict"), allowMissingColumns=True)
    ordered = both.repartition(n, "range").sortWithinPartitions("range", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, Sweep()
        for batch in batches:
            at, chosen, verdicts = [], [], []
            names = ("range", "key", "kind", "host", "path", "verdict")
            columns = [batch.column(c).to_pylist() for c in names]
            for i, (own, key, kind, own_host, own_path, verdict) in enumerate(zip(*columns, strict=True)):
                if own != current:
                    current, state = own, Sweep()
                if not kind:
                    state.open(key, own_path, verdict)
                    continue
                found = state.longest(key, own_path)
                at.append(i)
                # The end of the url's host that is as long as the rule's.
                chosen.append(own_host[len(own_host) + 1 - len(found[0]) :] * bool(found[0]) + found[1] if found else None)
                verdicts.append(found[2] if found else default)
            kept = batch.select(["page_id", "host", "path"]).take(pa.array(at, pa.int64()))
            arrays = [*kept.columns, pa.array(chosen, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "host", "path", "rule", "verdict"])

    texts = [StructField(c, StringType()) for c in ("host", "path", "rule", "verdict")]
    return ordered.mapInArrow(sweep, StructType([parts.schema["page_id"], *texts]))
