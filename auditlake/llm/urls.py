"""URL filters: a sort-merge range join with a sweep over nested rules.

A host is turned round, label by label, each label followed by a dot: ``www.example.com``
becomes ``com.example.www.``. A rule's host is then a prefix of the keys it fits, that is
an interval of the sorted keys, and two such intervals are nested or disjoint. URLs and
rules are cut into ranges of the key order; a rule is sent to every range its interval
meets. Each range is swept in order with a stack of the rule hosts that are open at the
current key. On each open host the longest of its paths that begins the URL's path fits; of
these rules the longest, host and path together, decides, of equals the innermost.

Range bounds come from a sample of about ``SAMPLES`` keys a range, and only balance the
work. Ranges grow in number with the rows, beyond ``LINEAR_RANGES`` with the root of them.
The sort key ends with a hash of the row's id, so a host, or even one URL, with a
third of all rows is cut into several ranges.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on up to ``?``, ``#`` or the end. A NULL URL or one without
``://`` has both empty, no rule, and the default verdict. Rules without host, path or
verdict are passed over; of equal rules the one with the larger verdict text is dropped,
so ``allow`` wins over ``block``. Repeated rows are judged each; empty tables give empty
results, and without rules all get the default.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES = 10
ROWS_PER_RANGE = 8_000
LINEAR_RANGES = 4_000
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(rest, upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each with a dot; an empty host has no key."""
    turned = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host == "", "").otherwise(turned)


def _assign(batches: Iterator[pa.RecordBatch], bounds: Sequence[tuple]) -> Iterator[pa.RecordBatch]:
    """Put the number of its range before each row, by binary search."""
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("key", "path", "salt")), strict=True)
        part = pa.array([bisect_right(bounds, (k.encode(), p.encode(), s)) for k, p, s in keys], pa.int32())
        yield pa.RecordBatch.from_arrays([part, *batch.columns], ["part", *batch.schema.names])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Judge sorted rows; rules come before the URLs of their key.

    The stack holds, for every open rule host, its key, its name and its paths.
    """
    part, stack = None, []
    for batch in batches:
        rules, verdicts = [], []
        columns = ("part", "key", "path", "is_url", "host", "verdict")
        for at, key, path, is_url, host, verdict in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            rule = said = None
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_url:
                for _, rule_host, known, lengths in reversed(stack):
                    hit = next((path[:n] for n in lengths if n <= len(path) and path[:n] in known), None)
                    if hit is not None and (rule is None or len(rule_host) + len(hit) > len(rule)):
                        rule, said = rule_host + hit, known[hit]
            else:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, []))
                known, lengths = stack[-1][2:]
                known[path] = verdict
                if len(path) not in lengths:
                    lengths.append(len(path))
                    lengths.sort(reverse=True)
            rules.append(rule)
            verdicts.append(said)
        judged = [*(batch.column(c) for c in ("row_id", "host", "path", "is_url")), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())]
        judged = pa.RecordBatch.from_arrays(judged, ["row_id", "host", "path", "is_url", "rule", "verdict"])
        yield judged.filter(pa.compute.equal(judged.column("is_url"), 1))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    row_id: str = "page_id",
    url: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """``row_id, host, path, rule, verdict`` of every URL; ``rules`` has host, path, verdict.

    A rule is written as its host followed by its path.
    """
    id_type = pages.schema[row_id].dataType.simpleString()
    asked = pages.select(
        F.col(row_id).alias("row_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.xxhash64(F.col(row_id), F.col(url)).alias("salt"),
    ).withColumn("key", reversed_host(F.col("host")))
    given = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("key", reversed_host(F.col("host")))
        .filter("key <> ''")
    )
    bounds = _bounds(asked)
    types = f"part int, row_id {id_type}, host string, path string, salt bigint, key string"
    asked = asked.mapInArrow(lambda batches: _assign(batches, bounds), types)
    # A rule meets the ranges from the one its key falls in to the last that its prefix
    # reaches; no key in UTF-8 holds the byte FF.
    keys = [key for key, _, _ in bounds]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key = row["key"].encode()
                parts = range(bisect_left(keys, key), bisect_right(keys, key + b"\xff") + 1)
                yield pa.RecordBatch.from_pylist([row | {"part": part} for part in parts], schema=spread_schema)

    spread_schema = pa.schema(
        [("part", pa.int32()), ("host", pa.string()), ("path", pa.string()), ("verdict", pa.string()), ("key", pa.string())]
    )
    given = given.mapInArrow(spread, "part int, host string, path string, verdict string, key string")
    both = asked.withColumns({"is_url": F.lit(1), "verdict": F.lit(None).cast("string")}).unionByName(
        given.withColumns({"is_url": F.lit(0)}), allowMissingColumns=True
    )
    both = both.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "key", "is_url", "path", "salt")
    swept = both.select("part", "key", "path", "is_url", "host", "verdict", "row_id").mapInArrow(
        _sweep, f"row_id {id_type}, host string, path string, is_url int, rule string, verdict string"
    )
    return swept.select(
        F.col("row_id").alias(row_id), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def _bounds(asked: DataFrame) -> list[tuple[bytes, bytes, int]]:
    """Where the ranges begin, but for the first, from a sample of the keys."""
    rows = asked.count()
    ranges = -(-rows // ROWS_PER_RANGE)
    if ranges > LINEAR_RANGES:
        ranges = int((LINEAR_RANGES * ranges) ** 0.5)
    if ranges < 2:
        return []
    drawn = asked.select("key", "path", "salt").sample(min(1.0, SAMPLES * ranges / rows), seed=3).collect()
    drawn = sorted({(r.key.encode(), r.path.encode(), r.salt) for r in drawn})
    return sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}) if drawn else []
