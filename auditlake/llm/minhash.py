"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A text is a set of word shingles; words are runs of anything but ASCII white space, A-Z
lower-cased. Two permutations make all coordinates of a signature: one breaks up the order
of the shingles, the other is shifted round by one for each coordinate. Rows of
coordinates are banded; with 44 bands of 6 a pair at the threshold of 0.8 is missed with a
probability below 2e-6, and one at 0.9 below 1e-14.

Texts with equal sets are one class, of which one takes part. A bucket of a band is never
expanded into its pairs: each member is compared with the bucket's least id, and what is
linked is joined to components. Only members that are then still in different components
are compared with one another, in blocks of bounded size, on their full sets. So every two
texts that meet in a bucket are either in one component or were compared.

NULL, empty and blank texts have no set and are linked with nothing. Fewer words than a
shingle has are one shingle. Rows without an id are linked with nothing, and kept. Rows
that share an id are one document, also with unlike texts: what is linked to one is linked
to all. Repeated rows get equal results. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.components import components
from auditlake.llm.native import table
from auditlake.llm.tokens import BASE, BY_SPACE, gram_hashes, hash_words, lists, mix, text_slices

SHINGLE = 5
PERCENT = 80
BLOCK = 500

ROWS, BANDS = 6, 44
# Odd multipliers of two bijections on 32 bits.
SIGMA = (np.uint32(0x7FEB352D), np.uint32(0x846CA68B))
PI = (np.uint32(0x2C1B3C6D), np.uint32(0x297A2D39))


def _permuted(x: np.ndarray, multipliers: tuple[np.uint32, np.uint32]) -> np.ndarray:
    """A pseudo-random permutation of the 32-bit numbers."""
    y = x * multipliers[0]
    y ^= y >> np.uint32(15)
    y *= multipliers[1]
    y ^= y >> np.uint32(13)
    return y


def signatures(shingles: np.ndarray, starts: np.ndarray, n: int = ROWS * BANDS) -> np.ndarray:
    """``n`` coordinates for each of the non-empty sets that begin at ``starts``.

    One permutation breaks up the order of the shingles. The other is shifted round by
    one for each coordinate, and the smallest value of the set is kept.
    """
    places = _permuted((shingles >> np.uint64(32)).astype(np.uint32), SIGMA)
    out = np.empty((len(starts), n), np.uint32)
    for k in range(n):
        out[:, k] = np.minimum.reduceat(_permuted(places + np.uint32(k), PI), starts)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    n, width = signature.shape
    parts = signature.reshape(n, width // rows, rows).astype(np.uint64)
    keys = np.arange(width // rows, dtype=np.uint64)[None, :] + np.uint64(1)
    keys = np.repeat(keys, n, axis=0)
    for j in range(rows):
        keys = mix(keys * BASE + parts[:, :, j])
    return keys


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingle hashes of each text, in runs of rows."""
    for low, high, data, offsets in text_slices(batch, "text"):
        words, ends = hash_words(data, offsets, BY_SPACE)
        found = []
        for i in range(high - low):
            own = words[ends[i] : ends[i + 1]]
            # what is shorter than a shingle is one of its own length
            found.append(np.unique(gram_hashes(own, min(shingle, len(own)))) if len(own) else own)
        yield found


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands``: set size, a 128-bit digest of the set, and
    its band keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found in _sets(batch, shingle):
                sizes = np.array([len(f) for f in found])
                keys = np.zeros((len(found), 0), np.uint64)
                digests = np.zeros((2, len(found)), np.uint64)
                if sizes.any():
                    flat = np.concatenate(found)
                    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
                    keys = np.zeros((len(found), BANDS), np.uint64)
                    keys[sizes > 0] = band_keys(signatures(flat, starts))
                    digests[0, sizes > 0] = np.add.reduceat(mix(flat + BASE), starts)
                    digests[1, sizes > 0] = np.add.reduceat(mix(flat ^ BASE), starts)
                bands = [keys[i] if n else keys[i][:0] for i, n in enumerate(sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(found)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests[0].view(np.int64)),
                        pa.array(digests[1].view(np.int64)),
                        lists([b.view(np.int64) for b in bands], pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )
                at += len(found)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"doc_id {kind}, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``node, shingles`` of each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found in _sets(batch, shingle):
                sets = lists([f.view(np.int64) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(found)), sets], ["node", "shingles"])
                at += len(found)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"node {kind}, shingles array<bigint>")


def _similar(a: str, b: str, percent: int):
    """Whether two set columns reach the similarity, in whole numbers."""
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``(doc_id, text)``.

    ``component_id`` is the least id that can be reached over links, the row's own
    included; the row with that id is kept.
    """
    docs = docs.select("doc_id", "text")
    drawn = table(sketches(docs, shingle), "sketches")
    first = drawn.filter("n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    whole = drawn.join(first, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"), F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")
    )
    whole = table(whole, "classes")
    banded = whole.filter("bands IS NOT NULL").select(F.col("rep").alias("node"), F.explode("bands").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
    heads = table(heads.filter("head <> last").select("key", "head"), "heads")
    buckets = table(banded.join(heads, "key").filter("node <> head"), "buckets")

    stars = buckets.select("node", "head").distinct()
    wanted = buckets.select("node").unionByName(heads.select(F.col("head").alias("node"))).distinct()
    chosen = docs.join(table(wanted, "wanted"), F.col("doc_id") == F.col("node"), "left_semi")
    sets = table(full_sets(chosen, shingle), "sets")
    pairs = stars.join(sets, "node").withColumnRenamed("shingles", "own").join(
        sets.select(F.col("node").alias("head"), "shingles"), "head"
    )
    # ids with unlike texts, and the least class that such an id is in
    several = whole.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("rep").alias("own"), F.max("rep").alias("last"), F.count_if(F.col("rep").isNull()).alias("blank")
    )
    several = table(several.filter("own <> last OR own IS NOT NULL AND blank > 0").select("doc_id", "own"), "several")
    links = pairs.filter(_similar("own", "shingles", percent)).select(F.col("node").alias("a"), F.col("head").alias("b"))
    of_one_id = whole.select("doc_id", "rep").join(several, "doc_id").filter("rep <> own")
    linked = components(links.unionByName(of_one_id.select(F.col("rep").alias("a"), F.col("own").alias("b"))))
    linked = table(linked, "stars-linked")

    across = components(_across(buckets, linked, sets, percent))
    across = across.select(F.col("node").alias("component"), F.col("component").alias("top"))
    # a component without a link across is not in that frame
    labels = linked.join(across, "component", "left").select("node", F.coalesce("top", "component").alias("component_id"))
    alone = across.join(linked, across["component"] == linked["node"], "left_anti").select(
        F.col("component").alias("node"), F.col("top").alias("component_id")
    )
    labels = table(labels.unionByName(alone), "labels")
    whole = whole.select("doc_id", "n_shingles", "rep").join(several, "doc_id", "left")
    whole = whole.withColumn("rep", F.coalesce("rep", "own"))
    named = whole.join(labels, whole["rep"] == labels["node"], "left")
    component = F.coalesce("component_id", "rep", "doc_id")
    return named.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _across(buckets: DataFrame, linked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components of which members share a bucket.

    A bucket's largest component need not be compared within itself; the members of its
    others visit all that live in the bucket. Residents and visitors are dealt into
    blocks, so a task holds two blocks of sets however large the bucket is.
    """
    placed = buckets.join(linked, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.max("n").alias("n_main"),
        F.sum("n").alias("n"),
        F.count("*").alias("parts"),
    )
    mixed = mixed.filter("parts > 1").drop("parts")
    dealt = placed.join(mixed, "key").withColumns(
        {
            "home": F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)),
            "seat": F.pmod(F.xxhash64("node"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK)),
        }
    )
    dealt = dealt.join(sets, "node")
    last = lambda count: F.ceil(count / BLOCK) - 1
    residents = dealt.select("key", F.col("home").alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), last(F.col("n") - F.col("n_main")))).alias("guests"), "node", "component", "shingles", F.lit(False).alias("visits"))
    visitors = dealt.filter("component <> main").select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), last(F.col("n")))).alias("block"), F.col("seat").alias("guests"), "node", "component", "shingles", F.lit(True).alias("visits"))

    def compare(group: pa.Table) -> pa.Table:
        component = group.column("component").combine_chunks()
        part = component.to_pylist()
        sets_of = [np.asarray(x.values) for x in group.column("shingles")]
        visits = group.column("visits").to_pylist()
        homes = [i for i, v in enumerate(visits) if not v]
        a, b = [], []
        if not homes:
            return pa.table({"a": pa.array(a, component.type), "b": pa.array(b, component.type)})
        flat = np.concatenate([sets_of[i] for i in homes])
        sizes = np.array([len(sets_of[i]) for i in homes])
        starts = np.cumsum(sizes) - sizes
        parts = np.array([part[i] for i in homes], dtype=object)
        for i in (i for i, v in enumerate(visits) if v):
            own = sets_of[i]
            spots = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            shared = np.add.reduceat((own[spots] == flat).astype(np.int64), starts)
            near = 100 * shared >= percent * (sizes + len(own) - shared)
            for other in set(parts[near]) - {part[i]}:
                a.append(part[i])
                b.append(other)
        return pa.table({"a": pa.array(a, component.type), "b": pa.array(b, component.type)})

    kind = sets.schema["node"].dataType.simpleString()
    together = residents.unionByName(visitors).groupBy("key", "block", "guests")
    return together.applyInArrow(compare, f"a {kind}, b {kind}").distinct()
