"""Vector code compression: a codebook for each part of a vector, learned over metric trees.

A component x becomes the integer floor(scale * x), and a vector is cut into equal
consecutive parts. Codebooks are learned by rounds of nearest-entry assignment and floored
means, in integers, so results do not depend on the order of rows or the number of tasks.
Each task builds a metric tree (``balls.py``) per part position over blocks of vectors, once;
a round then only passes entries down the trees, where a ball that one entry owns adds its
cached sum and count without its points being looked at. The trees are a table in the shared
folder, and a round sends one row per part and entry from each task.

Dropped are vectors that are NULL, empty, not to be cut into so many parts, or with a NULL or
not finite component, and those of another length than the vector with the smallest id has.
Scaled components beyond +-2^27 are cut to that bound. Codebooks start as the vectors of the
smallest ids, one per id: the least vector where an id is repeated. NULL ids come last, and
are one id. Fewer ids give fewer entries. Ties go to the lower entry, unused entries stay.
Repeated rows count and are coded each; NULL labels are one label. Nothing kept gives no rows.
Columns other than the three named play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm import balls
from auditlake.llm.native import joined_by_key, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 4_096


@dataclass
class Codebooks:
    """Integer entries by part, entry and position."""

    entries: np.ndarray

    def text(self) -> str:
        return ",".join(str(x) for x in self.entries.reshape(-1).tolist())

    def digest(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def _valid(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite, F.lit(False))


def _scaled(values: np.ndarray, scale: int) -> np.ndarray:
    most = balls.LARGEST
    return np.clip(np.floor(values.astype(np.float64) * scale), -most, most).astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one length without NULLs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _first_vectors(kept: DataFrame, wanted: int) -> list[list[float]]:
    """Vectors of the smallest ids, one for each; only so many rows come to the driver."""
    found: dict = {}
    rest = kept
    while len(found) < wanted:
        # an id may be repeated any number of times, so the next ids are asked for anew
        rows = rest.orderBy(F.col("id").asc_nulls_last(), "vector").limit(wanted).collect()
        for row in rows:
            found.setdefault(row.id, row.vector)
        if len(rows) < wanted or rows[-1].id is None:
            break
        rest = kept.filter((F.col("id") > F.lit(rows[-1].id)) | F.col("id").isNull())
    return list(found.values())[:wanted]


def _planted(kept: DataFrame, parts: int, width: int, scale: int) -> DataFrame:
    """Blocks of vectors: ``id, label`` lists and a packed tree for each part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                own = batch.slice(low, BLOCK)
                points = _scaled(_matrix(own.column("vector"), width), scale).reshape(own.num_rows, parts, -1)
                trees = [balls.build(np.ascontiguousarray(points[:, k])).pack() for k in range(parts)]
                ends = pa.array([0, own.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, own.column(c)) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], ["id", "label", "trees"])

    kinds = [kept.schema[c].dataType.simpleString() for c in ("id", "label")]
    return kept.mapInArrow(work, f"id array<{kinds[0]}>, label array<{kinds[1]}>, trees array<binary>")


def _one_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round over all blocks."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for trees in batch.column("trees"):
                for k, data in enumerate(trees):
                    n, total = balls.totals(balls.Tree.unpack(data.as_py()), books[k])
                    counts[k] += n
                    sums[k] += total
        at = np.argwhere(counts > 0)
        if len(at):
            each = sums[at[:, 0], at[:, 1]]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), pa.array(each.reshape(-1)))
            columns = [pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(counts[at[:, 0], at[:, 1]]), lists]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    partial = blocks.select("trees").mapInArrow(work, "part bigint, entry bigint, n bigint, sums array<bigint>")
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    # one row per part and entry, however many vectors there are
    found = books.copy()
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():
        found[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    return found


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every vector."""
    ids, labels = (blocks.schema[c].dataType.elementType.simpleString() for c in ("id", "label"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own = batch.slice(at, 1)
                found = [balls.nearest(balls.Tree.unpack(t.as_py()), books[k]) for k, t in enumerate(own.column("trees")[0])]
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                errors = sum(error for _, error in found)
                columns = [*(own.column(c).flatten() for c in ("id", "label")), pa.array([c.tobytes().hex() for c in codes]), pa.array(errors)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return blocks.mapInArrow(work, f"id {ids}, label {labels}, code string, error bigint")


def compress(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``key, label, code, error, label_error`` of the kept vectors, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError(f"a code byte holds up to 256 entries, not {entries}")
    spark = vectors.sparkSession
    valid = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    valid = valid.filter(_valid(F.col("vector"), parts))
    first = _first_vectors(valid, 1)
    width = len(first[0]) if first else parts
    kept = valid.filter(F.size("vector") == width)
    starts = _first_vectors(kept, entries) if first else []
    books = _scaled(np.array(starts, np.float64).reshape(-1, width), scale).reshape(len(starts), parts, width // parts).swapaxes(0, 1)
    if not first:
        kinds = f"{key} {vectors.schema[key].dataType.simpleString()}, {label} {vectors.schema[label].dataType.simpleString()}"
        return spark.createDataFrame([], f"{kinds}, code string, error bigint, label_error bigint"), Codebooks(books)
    blocks = table(_planted(kept, parts, width, scale), "trees")
    for _ in range(rounds):
        books = _one_round(blocks, books)
    coded = table(_coded(blocks, books), "codes")
    by_label = table(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    whole = joined_by_key(coded, by_label, "label", "n")
    found = whole.select(F.col("id").alias(key), F.col("label").alias(label), "code", "error", "label_error")
    return found, Codebooks(books)
