"""Toxicity by a convolutional text classifier in numpy.

A word's vector is the mean of hashed embeddings of the word and of its first few bytes, so
words of one stem share part of it. Filters one, two and three words wide pass over the
whole text; each filter's largest response counts, and a logistic layer makes the score.
Since the largest response is all that matters, its place alone gets a gradient.

Networks are fitted on at most ``per_class`` labelled texts of each label, drawn by a hash of
their id, of at most ``most_words`` words each; a word is one number there, and its embedding
rows are kept once for all texts. Each network is fitted in a task of its own. The classifier
is a few networks that differ in their seed; their log odds are averaged. As the classes are
drawn evenly, the score is moved to the share that the label has among all training rows,
with a miss held ``miss_cost`` times as bad as a false alarm, so 0.5 is where to decide.

Thresholds by language come from scores that labels had no part in: ids fall into a few
folds by a hash, and each fold is scored by a network fitted without it. All labelled texts
are scored whole, in the mix of labels they have, and counted by language and bin of the
score, so the driver gets counts only. A language has a threshold of its own, the one with
the best F1, if at least ``MIN_HITS`` of its texts bear the label; the others share the one
found over all languages. The score itself knows no language.

Scoring reads whole texts; texts are worked off in pieces and a piece keeps only the largest
responses. NULL and empty texts get the score of no response. Without labelled texts of both
labels the score is the label's share, or 0. Rows without an id or label teach nothing; of
unlike labels for one id the larger counts. Repeated rows are scored each. An empty table
gives an empty one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.native import key_sketch, may_hold, table
from auditlake.llm.tokens import BY_ALNUM, hash_words, text_slices

BUCKETS, WIDTH_OF_VECTOR, FILTERS, WIDTHS = 1 << 17, 16, 16, (1, 2, 3)
PREFIXES = (3, 4, 5, 6, 7)
PER_CLASS, MOST_WORDS, MISS_COST = 3_000, 4_000, 4
STEPS, BATCH, RATE, SEED, MEMBERS = 600, 32, 0.05, 11, 3
# Folds of ids, each scored without its labels; bins of the log odds, up to both ends.
FOLDS, BINS_A_UNIT, END_OF_BINS, MIN_HITS = 5, 50, 40, 50


@dataclass
class Network:
    """Embedding rows, filters by width, and the logistic layer."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    shift: float = 0.0
    seed: int = SEED
    sums: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        draw = np.random.default_rng(seed)
        return cls(
            (draw.standard_normal((BUCKETS, WIDTH_OF_VECTOR)) * 0.1).astype(np.float32),
            {w: (draw.standard_normal((w, WIDTH_OF_VECTOR, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS},
            {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
            (draw.standard_normal(len(WIDTHS) * FILTERS) * 0.1).astype(np.float32),
            np.zeros(1, np.float32),
            seed=seed,
        )

    def pack(self) -> bytes:
        """Without the embedding rows that are as the seed made them."""
        moved = np.flatnonzero((self.embedding != Network.fresh(self.seed).embedding).any(1))
        rest = (self.filters, self.offsets, self.out, self.bias, self.shift, self.seed)
        return pickle.dumps((moved.astype(np.int32), self.embedding[moved], *rest))

    @classmethod
    def unpack(cls, data: bytes) -> Network:
        moved, rows, filters, offsets, out, bias, shift, seed = pickle.loads(data)
        embedding = cls.fresh(seed).embedding
        embedding[moved] = rows
        return cls(embedding, filters, offsets, out, bias, shift, seed)

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        return self.embedding[buckets].mean(axis=1)

    def responses(self, vectors: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
        """Filter responses at every place; the last ``width - 1`` places have none."""
        n = len(words) - width + 1
        total = self.offsets[width][None, :]
        for j in range(width):
            total = total + (vectors @ self.filters[width][j])[words[j : j + n]]
        return total

    def step(self, name: object, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Adagrad, on some rows of an array or on all."""
        seen = self.sums.setdefault(name, np.full(value.shape, 1e-6, np.float32))
        at = slice(None) if rows is None else rows
        seen[at] += gradient**2
        value[at] -= RATE * gradient / np.sqrt(seen[at])


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of each word, one for itself and one for each prefix; text bounds."""
    hashes, ends, *prefixes = hash_words(data, offsets, BY_ALNUM, prefixes=PREFIXES)
    rows = [hashes, *(p ^ np.uint64(n) for n, p in zip(PREFIXES, prefixes, strict=True))]
    return np.stack([(r >> np.uint64(20)) % np.uint64(BUCKETS) for r in rows], axis=1).astype(np.int32), ends


def fit(texts: list[np.ndarray], vocabulary: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Network:
    """Train on texts given as numbers of words, whose embedding rows the vocabulary has."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    ones, zeros = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    for _ in range(steps):
        chosen = np.concatenate([draw.choice(ones, BATCH // 2), draw.choice(zeros, BATCH // 2)])
        _one_step(net, [texts[i] for i in chosen], vocabulary, labels[chosen].astype(np.float32))
    net.sums.clear()
    return net


def _one_step(net: Network, texts: list[np.ndarray], vocabulary: np.ndarray, labels: np.ndarray) -> None:
    sizes = [len(t) for t in texts]
    starts = np.cumsum([0, *sizes])
    known, words = np.unique(np.concatenate(texts), return_inverse=True)
    buckets = vocabulary[known]
    vectors = net.vectors(buckets)
    pooled = np.zeros((len(texts), len(WIDTHS), FILTERS), np.float32)
    places = np.zeros((len(texts), len(WIDTHS), FILTERS), int)
    for k, width in enumerate(WIDTHS):
        if len(words) < width:
            continue
        found = net.responses(vectors, words, width)
        for i, (low, size) in enumerate(zip(starts, sizes, strict=False)):
            if size >= width:
                own = found[low : low + size - width + 1]
                places[i, k] = own.argmax(0) + low
                pooled[i, k] = np.maximum(own.max(0), 0)
    flat = pooled.reshape(len(texts), -1)
    score = 1 / (1 + np.exp(-(flat @ net.out + net.bias)))
    error = (score - labels) / len(texts)
    back = (error[:, None] * net.out[None, :]).reshape(pooled.shape) * (pooled > 0)
    d_vectors = np.zeros_like(vectors)
    steps = []
    for k, width in enumerate(WIDTHS):
        gradient = np.zeros_like(net.filters[width])
        for j in range(width):
            at = words[np.minimum(places[:, k] + j, len(words) - 1)] if len(words) else np.zeros((len(texts), FILTERS), int)
            if len(words):
                gradient[j] = np.einsum("df,dfk->kf", back[:, k], vectors[at])
                spread = back[:, k][:, :, None] * net.filters[width][j].T[None]
                np.add.at(d_vectors, at.reshape(-1), spread.reshape(-1, WIDTH_OF_VECTOR))
        steps.append((("filters", width), net.filters[width], gradient))
        steps.append((("offsets", width), net.offsets[width], back[:, k].sum(0)))
    steps.append(("out", net.out, flat.T @ error))
    steps.append(("bias", net.bias, error.sum(keepdims=True)))
    for name, value, gradient in steps:
        net.step(name, value, gradient)
    touched = np.flatnonzero(d_vectors.any(axis=1))
    rows, at = np.unique(buckets[touched].reshape(-1), return_inverse=True)
    gradient = np.zeros((len(rows), WIDTH_OF_VECTOR), np.float32)
    np.add.at(gradient, at.reshape(-1), np.repeat(d_vectors[touched] / buckets.shape[1], buckets.shape[1], axis=0))
    net.step("embedding", net.embedding, gradient, rows)


def word_keys(buckets: np.ndarray) -> np.ndarray:
    """One number for the embedding rows of each word."""
    powers = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, buckets.shape[1] + 1, dtype=np.uint64)
    return (buckets.astype(np.uint64) @ powers).astype(np.int64)


def pooled_of(net: Network, known: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Largest responses in each of several texts, given as numbers of known words."""
    out = np.zeros((len(ends) - 1, len(WIDTHS), FILTERS), np.float32)
    if not len(words):
        return out.reshape(len(out), -1)
    vectors = net.vectors(known)
    sizes = np.diff(ends)
    for k, width in enumerate(WIDTHS):
        long = sizes >= width
        if not long.any():
            continue
        found = net.responses(vectors, words, width)
        # places where a window would run into the next text do not count
        for j in range(1, width):
            edge = ends[1:-1] - j
            found[edge[(edge >= 0) & (edge < len(found))]] = -np.inf
        tops = np.maximum.reduceat(found, np.minimum(ends[:-1][long], len(found) - 1), axis=0)
        out[long, k] = np.maximum(tops, 0)
    return out.reshape(len(out), -1)


def score_of(nets: Sequence[Network], buckets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores of several texts by some networks together."""
    # each distinct word's vector is made once
    _, first, words = np.unique(word_keys(buckets), return_index=True, return_inverse=True)
    known = buckets[first]
    odds = sum((pooled_of(net, known, words, ends) @ net.out + net.bias + net.shift).astype(np.float64) for net in nets)
    return 1 / (1 + np.exp(-odds / len(nets)))


def score(docs: DataFrame, net: Sequence[bytes] | float) -> DataFrame:
    """``docs`` with ``score`` in place of the text; ``net`` holds packed networks, or is a
    constant score."""
    if isinstance(net, float):
        return docs.drop("text").withColumn("score", F.lit(net))
    return _scored(docs.withColumn("_net", F.lit(0)), [net]).drop("_net")


def _scored(docs: DataFrame, nets: Sequence[Sequence[bytes]]) -> DataFrame:
    """``docs`` with ``score`` in place of the text, by the packed networks ``_net`` names."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(list(nets))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: dict[int, list[Network]] = {}
        for whole in batches:
            picked = whole.column("_net").to_numpy()
            for number in np.unique(picked):
                if number not in models:
                    models[number] = [Network.unpack(data) for data in shared.value[number]]
                model, batch = models[number], whole.filter(pa.array(picked == number))
                scores = []
                for _, _, data, offsets in text_slices(batch, "text"):
                    scores.append(score_of(model, *word_buckets(data, offsets)))
                kept = [batch.column(f.name) for f in rest]
                flat = np.concatenate(scores) if scores else np.empty(0)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(flat, pa.float64())], [*(f.name for f in rest), "score"])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "score double"])
    return docs.mapInArrow(work, kinds)


@dataclass
class Trained:
    """Packed networks, or the constant that stands in for them; thresholds by language, and
    the one of the languages that have none."""

    net: list[bytes] | float
    thresholds: dict[str, float]
    texts: int
    common: float = 0.5


@dataclass
class _Sample:
    """Texts as numbers of words, the embedding rows of the words, labels and folds."""

    texts: list[np.ndarray]
    vocabulary: np.ndarray
    labels: np.ndarray
    folds: np.ndarray

    def without(self, fold: int | None) -> np.ndarray:
        return np.flatnonzero(self.folds != fold) if fold is not None else np.arange(len(self.texts))

    def can_fit(self, fold: int | None = None) -> bool:
        return len(set(self.labels[self.without(fold)])) == 2


def _fitted(spark: SparkSession, sample: _Sample, wanted: Sequence[tuple[int | None, int]], shift: float) -> list[bytes]:
    """A packed network for each ``(fold to leave out, seed)``, each fitted in a task of its own.

    They are a table first and come to the driver one after another.
    """
    shared = spark.sparkContext.broadcast((sample, list(wanted)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, jobs = shared.value
        for batch in batches:
            for job in batch.column("job").to_pylist():
                fold, seed = jobs[job]
                at = own.without(fold)
                net = fit([own.texts[i] for i in at], own.vocabulary, own.labels[at], seed=seed)
                net.shift = shift
                yield pa.RecordBatch.from_arrays([pa.array([job]), pa.array([net.pack()])], ["job", "net"])

    jobs = spark.range(len(wanted), numPartitions=len(wanted)).withColumnRenamed("id", "job")
    nets = table(jobs.mapInArrow(work, "job bigint, net binary"), "networks")
    shared.unpersist()
    return [bytes(nets.filter(F.col("job") == k).first().net) for k in range(len(wanted))]


def _sample(chosen: DataFrame, most_words: int) -> _Sample:
    """Drawn rows of ``doc_id, label, fold, text`` for the driver; their number is bounded."""
    per_word = 1 + len(PREFIXES)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch, "text"):
                buckets, ends = word_buckets(data, offsets)
                keys = word_keys(buckets)
                keep = [i for i in range(high - low) if ends[i + 1] - ends[i] <= most_words]
                index = pa.array([low + i for i in keep], pa.int64())
                own = pa.array([keys[ends[i] : ends[i + 1]] for i in keep], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(index) for c in ("doc_id", "label", "fold")), own], ["doc_id", "label", "fold", "words"])

    def rows_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch, "text"):
                buckets, ends = word_buckets(data, offsets)
                short = np.repeat(np.diff(ends) <= most_words, np.diff(ends))
                keys, first = np.unique(word_keys(buckets[short]), return_index=True)
                rows = pa.FixedSizeListArray.from_arrays(pa.array(buckets[short][first].reshape(-1)), per_word)
                yield pa.RecordBatch.from_arrays([pa.array(keys), rows.cast(pa.list_(pa.int32()))], ["word", "rows"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    texts = chosen.mapInArrow(words, f"doc_id {kind}, label int, fold int, words array<bigint>").toArrow()
    # rows that share an id differ in their words
    texts = texts.append_column("size", pa.compute.list_value_length(texts.column("words")))
    texts = texts.sort_by([("doc_id", "ascending"), ("size", "ascending")])
    known = chosen.select("text").mapInArrow(rows_of_words, "word bigint, rows array<int>").distinct().toArrow().sort_by("word")
    keys = known.column("word").to_numpy()
    vocabulary = known.column("rows").combine_chunks().flatten().to_numpy().reshape(-1, per_word)
    numbers = [np.searchsorted(keys, np.asarray(t.values)).astype(np.int32) for t in texts.column("words")]
    return _Sample(numbers, vocabulary, *(np.array(texts.column(c).to_pylist(), int) for c in ("label", "fold")))


def _fold(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")


def train(
    docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, most_words: int = MOST_WORDS, miss_cost: float = MISS_COST, seed: int = SEED
) -> Trained:
    """Fit on rows of ``(doc_id, text, lang)`` and ``(doc_id, label)``."""
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = table(known, "toxic-labels")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if not 0 < share < 1:
        return Trained(float(share), {}, 0)
    drawn = [
        known.filter(F.col("label") == label).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(per_class)
        for label in (0, 1)
    ]
    # at most 2 * per_class ids, so they may be broadcast
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))
    chosen = docs.join(drawn, "doc_id").select("doc_id", F.col("label").cast("int"), _fold(seed).alias("fold"), "text")
    sample = _sample(table(chosen, "toxic-sample"), most_words)
    shift = float(np.log(miss_cost * share / (1 - share)))
    if not sample.can_fit():
        return Trained(float(share), {}, len(sample.texts))
    members = [(None, seed + k) for k in range(MEMBERS)]
    folds = [(k, seed) for k in range(FOLDS)] if all(sample.can_fit(k) for k in range(FOLDS)) else []
    nets = _fitted(docs.sparkSession, sample, members + folds, shift)
    net, apart = nets[:MEMBERS], [[n] for n in nets[MEMBERS:]]
    if not apart:
        return Trained(net, {}, len(sample.texts))
    # every text that may have a label is scored, then joined by its id without its words
    sketch = key_sketch(known, F.xxhash64("doc_id"))
    asked = may_hold(docs.select("doc_id", "lang", "text"), sketch, F.xxhash64("doc_id"))
    scored = table(_scored(asked.withColumn("_net", _fold(seed)), apart), "toxic-scores")
    judged = scored.join(known, "doc_id").select("lang", F.col("label").cast("int"), "score")
    thresholds, common = thresholds_by_language(judged)
    return Trained(net, thresholds, len(sample.texts), common)


def thresholds_by_language(scored: DataFrame, min_hits: int | None = None) -> tuple[dict[str, float], float]:
    """Best thresholds of rows of ``(lang, label, score)``, from counts by bin, and the best
    one over all languages."""
    odds = F.ln(F.col("score") / (1 - F.col("score")))
    # a score of 0 or 1 has no odds
    odds = F.when(F.col("score") <= 0, -END_OF_BINS).when(F.col("score") >= 1, END_OF_BINS).otherwise(odds)
    at = F.floor(F.greatest(F.least(odds, F.lit(END_OF_BINS)), F.lit(-END_OF_BINS)) * BINS_A_UNIT)
    counted = scored.groupBy("lang", at.alias("bin")).agg(
        F.count("*").alias("n"), F.sum("label").alias("hits"), F.min("score").alias("low"), F.max("score").alias("high")
    )
    bins: dict[str | None, list] = {}
    together: dict[int, list] = {}
    for r in counted.orderBy("lang", F.desc("bin")).collect():
        bins.setdefault(r.lang, []).append((r.n, r.hits, r.low, r.high))
        together.setdefault(r.bin, []).append((r.n, r.hits, r.low, r.high))
    found = {}
    for lang, rows in bins.items():
        n, hits, low, high = map(np.array, zip(*rows, strict=True))
        if lang is not None and hits.sum() >= (MIN_HITS if min_hits is None else min_hits) and hits.sum() < n.sum():
            found[str(lang)] = best_cut(n, hits, low, high)
    merged = []
    for _, rows in sorted(together.items(), reverse=True):
        n, hits, low, high = zip(*rows, strict=True)
        merged.append((sum(n), sum(hits), min(low), max(high)))
    if not merged:
        return found, 0.5
    n, hits, low, high = map(np.array, zip(*merged, strict=True))
    return found, best_cut(n, hits, low, high) if 0 < hits.sum() < n.sum() else 0.5


def best_cut(n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The score between the two bins, given in falling order, where F1 is best."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    at = int(f1.argmax())
    below = high[at + 1] if at + 1 < len(n) else 0.0
    return float((low[at] + below) / 2)


def flagged(score: Column, lang: Column, thresholds: Mapping[str, float], default: float = 0.5) -> Column:
    """Whether a score reaches its language's threshold."""
    if not thresholds:
        return score >= default
    table = F.create_map(*[F.lit(x) for item in thresholds.items() for x in item])
    return score >= F.coalesce(F.try_element_at(table, lang), F.lit(default))
