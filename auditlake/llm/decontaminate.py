"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased.
Of every run of overlapping k-grams that makes up a window, the smallest hash is kept (the
last of equals). Two texts that share a whole window keep the same hash in it, so every
shared window is found; windows have ``window`` words, with k = window / 2. Items of fewer
words are one window each and get fingerprints for their own length, on both sides.

A sketch of the benchmark's fingerprints, of fixed size, leaves out most of the documents',
and the rest are joined. A document that shares one with an item is read again and meets
the item's words, which come to the tasks in blocks of bounded size; every shared
fingerprint is extended as far as the words agree. A run of a whole window or more is a hit,
and its words are marked.

NULL and empty texts have no words and hit nothing. Repeated rows are judged each; items
that repeat are counted once by their id. Rows without an id are judged too. An item
without id hits like any other, items without id count as one, and have no name. Other columns play no
part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.llm.native import hinted, key_sketch, may_hold, table
from auditlake.llm.tokens import BY_ALNUM, gram_hashes, hash_words, lists, text_slices

WINDOW = 10
# Words of the items that tasks hold at once, eight bytes each.
BLOCK_WORDS = 4_000_000


def parts_of(length: int) -> tuple[int, int]:
    """Words of a k-gram, and k-grams of a window of ``length`` words."""
    k = (length + 1) // 2
    return k, length - k + 1


def winnow(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one text for windows of ``length`` words, and where they begin."""
    k, width = parts_of(length)
    grams = gram_hashes(hashes, k)
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        other = grams[j : j + n]
        smaller = other <= best
        best[smaller], at[smaller] = other[smaller], j
    at = np.unique(at + np.arange(n))
    # a gram stands for its length as well
    return grams[at] ^ np.uint64(length), at


def _words(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    for low, high, data, offsets in text_slices(batch, column):
        hashes, ends = hash_words(data, offsets, BY_ALNUM)
        for i in range(high - low):
            yield low + i, hashes[ends[i] : ends[i + 1]]


def fingerprints(rows: DataFrame, text: str, lengths: Sequence[int]) -> DataFrame:
    """``rows`` with ``n_words`` and ``fps``, the distinct fingerprints, for the text."""
    kept = [f for f in rows.schema.fields if f.name != text]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for _, words in _words(batch, text):
                sizes.append(len(words))
                prints = np.concatenate([winnow(words, n)[0] for n in lengths])
                found.append(np.unique(prints).view(np.int64))
            rest = [batch.column(f.name) for f in kept]
            names = [*(f.name for f in kept), "n_words", "fps"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), lists(found, pa.int64())], names)

    return rows.mapInArrow(scan, T.StructType([*kept]).add("n_words", T.LongType()).add("fps", T.ArrayType(T.LongType())))


def item_words(items: DataFrame, window: int) -> DataFrame:
    """``item_id, words, length, inner``: word hashes of each distinct item, the words of its
    windows, and a hash of its words, by which it is known where it has no id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words for _, words in _words(batch, "text")]
            sizes = pa.array([min(window, len(w)) for w in found], pa.int32())
            words = lists([w.view(np.int64) for w in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), words, sizes], ["item_id", "words", "length"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(scan, f"item_id {kind}, words array<bigint>, length int")
    return found.filter("length > 0").distinct().withColumn("inner", F.xxhash64("words"))


def extended(doc: np.ndarray, item: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Runs of ``length`` words or more that both texts share, as spans of the document.

    Shared fingerprints give the diagonals to look at; each is compared once.
    """
    doc_fps, doc_at = winnow(doc, length)
    item_fps, item_at = winnow(item, length)
    common = np.isin(doc_fps, item_fps)
    places = defaultdict(list)
    for fp, at in zip(item_fps.tolist(), item_at.tolist(), strict=True):
        places[fp].append(at)
    diagonals = {p - q for fp, p in zip(doc_fps[common].tolist(), doc_at[common].tolist(), strict=True) for q in places[fp]}
    spans = []
    for d in diagonals:
        low, high = max(0, d), min(len(doc), d + len(item))
        same = doc[low:high] == item[low - d : high - d]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
        spans += [(low + a, low + b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= length]
    return spans


def _edges(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of marked words, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).tolist()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One list of runs for the lists that the blocks of items gave."""
    for batch in batches:
        hits, spans = [], []
        for lists_of_edges in batch.column("edges").to_pylist():
            hit = np.zeros(max(e[-1] for e in lists_of_edges), bool)
            for edges in lists_of_edges:
                for low, high in zip(edges[::2], edges[1::2], strict=True):
                    hit[low:high] = True
            hits.append(int(hit.sum()))
            spans.append(_edges(hit))
        columns = [pa.array(hits, pa.int64()), pa.array(spans, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("body"), *columns], ["row_id", "body", "n_hit", "edges"])


def _blocks(bench: DataFrame) -> list[DataFrame]:
    """The items in blocks of about ``BLOCK_WORDS`` words; one for most benchmarks."""
    words = bench.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    n = -(-words // BLOCK_WORDS)
    return [bench.filter(F.pmod(F.xxhash64("inner"), F.lit(n)) == k) for k in range(n)]


def _held(block: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Words and window length of the items of a block, which is of bounded size."""
    rows = block.select("inner", "words", "length").dropDuplicates(["inner"]).toArrow().combine_chunks()
    words = (np.asarray(w.values).view(np.uint64) for w in rows.column("words"))
    return dict(zip(rows.column("inner").to_pylist(), zip(words, rows.column("length").to_pylist(), strict=True), strict=True))


def contaminated(
    docs: DataFrame, items: DataFrame, *, row_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``row_id, body, n_words, n_hit, item_ids, n_items, edges`` of each document.

    ``n_items`` counts the ids of items that hit, those without one as one id more;
    ``body`` is a hash of the text; ``edges`` are starts and ends, in words, of the runs
    that were hit, one after the other. Only documents that share a fingerprint are
    read a second time, and only they are shuffled with their texts.
    """
    bench = table(item_words(items, window), "items")
    lengths = sorted(r.length for r in bench.select("length").distinct().collect())
    item_kind = bench.schema["item_id"].dataType.simpleString()
    id_kind = docs.schema[row_id].dataType.simpleString()
    body = F.xxhash64(F.coalesce(text, F.lit("")))
    docs = docs.select(F.col(row_id).alias("row_id"), body.alias("body"), F.col(text).alias("text"))

    def item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column("words"), batch.column("length").to_pylist(), strict=True)
            found = [np.unique(winnow(np.asarray(w.values).view(np.uint64), n)[0]).view(np.int64) for w, n in sizes]
            yield pa.RecordBatch.from_arrays([batch.column("inner"), lists(found, pa.int64())], ["inner", "fps"])

    bench_fps = bench.mapInArrow(item_prints, "inner bigint, fps array<bigint>")
    bench_fps = table(bench_fps.select("inner", F.explode("fps").alias("fp")).distinct(), "item-prints")
    prints = fingerprints(docs, "text", lengths or [window])
    # the first entry stands for the row itself, so rows are counted though they share a key
    each = prints.select("row_id", "body", "n_words", F.posexplode(F.concat(F.array("body"), "fps")).alias("nth", "fp"))
    known = table(bench_fps.select("fp").distinct(), "known-prints")
    told = hinted(each, key_sketch(known, F.col("fp")), F.col("fp"), "may")
    told = table(told.filter("nth = 0 OR may"), "doc-prints")
    shared = told.filter("nth > 0").join(known, "fp", "left_semi")
    flags = (
        told.filter("nth = 0")
        .unionByName(shared)
        .groupBy("row_id", "body")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count_if(F.col("nth") == 0).alias("copies"),
            F.count_if(F.col("nth") > 0).alias("shared"),
        )
    )
    flags = table(flags, "flags")
    same = lambda a, b: a["row_id"].eqNullSafe(b["row_id"]) & (a["body"] == b["body"])
    keys = flags.filter("shared > 0").select("row_id", "body")
    row_hash = F.xxhash64("row_id", "body")
    asked = may_hold(docs, key_sketch(keys, row_hash), row_hash)
    suspects = table(asked.join(keys, same(asked, keys), "left_semi").dropDuplicates(["row_id", "body"]), "suspects")
    found = fingerprints(suspects, "text", lengths or [window]).select("row_id", "body", F.explode("fps").alias("fp"))
    pairs = table(found.join(bench_fps, "fp").select("row_id", "body", "inner").distinct(), "pairs")

    def extend(batches: Iterator[pa.RecordBatch], held: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans = [], []
            for i, words in _words(batch, "text"):
                hit, named = np.zeros(len(words), bool), []
                for inner in batch.column("inners")[i].as_py():
                    item_words, length = held[inner]
                    own = extended(words, item_words, length)
                    for low, high in own:
                        hit[low:high] = True
                    if own:
                        named.append(inner)
                ids.append(named)
                spans.append(_edges(hit))
            columns = [pa.array(ids, pa.list_(pa.int64())), pa.array(spans, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("body"), *columns], ["row_id", "body", "inners", "edges"])

    parts = []
    for block in _blocks(bench):
        wanted = pairs.join(F.broadcast(block.select("inner")), "inner", "left_semi")
        wanted = wanted.groupBy("row_id", "body").agg(F.collect_set("inner").alias("inners"))
        both = suspects.join(wanted, same(suspects, wanted)).select(suspects["row_id"], suspects["body"], "text", "inners")
        shared_words = docs.sparkSession.sparkContext.broadcast(_held(block))
        kinds = f"row_id {id_kind}, body bigint, inners array<bigint>, edges array<bigint>"
        # bound now, as the loop goes on before anything runs
        told = both.mapInArrow(lambda batches, words=shared_words: extend(batches, words.value), kinds)
        parts.append(table(told.filter(F.size("edges") > 0), "hits"))
    empty = docs.sparkSession.createDataFrame([], f"row_id {id_kind}, body bigint, inners array<bigint>, edges array<bigint>")
    by_block = reduce(DataFrame.unionByName, parts, empty)
    hits = by_block.groupBy("row_id", "body").agg(
        F.collect_list("edges").alias("edges"), F.flatten(F.collect_list("inners")).alias("inners")
    )
    merged = hits.select("row_id", "body", "edges").mapInArrow(_merged, f"row_id {id_kind}, body bigint, n_hit bigint, edges array<bigint>")
    # items by their ids, of which several rows may share one, or have none
    named = hits.select("row_id", "body", F.explode("inners").alias("inner")).join(bench.select("inner", "item_id"), "inner")
    named = named.groupBy("row_id", "body").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item_id").alias("n_named"), F.max(F.col("item_id").isNull()).alias("nameless"))
    hits = merged.join(named, same(merged, named)).select(
        merged["row_id"], merged["body"], "n_hit", "item_ids", (F.col("n_named") + F.col("nameless").cast("bigint")).alias("n_items"), "edges"
    )
    judged = flags.join(hits, same(flags, hits), "left").select(
        flags["row_id"].alias(row_id), flags["body"], "n_words", "copies", "n_hit", "item_ids", "n_items", "edges"
    )
    return judged.select(
        row_id,
        "body",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast(f"array<{item_kind}>")).alias("item_ids"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("edges", F.array().cast("array<bigint>")).alias("edges"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
    ).drop("copy")
