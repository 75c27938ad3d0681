"""Language identification by rank-order profiles of character n-grams.

A profile is a list of the most frequent n-grams of one to three letters, by rank. Letters
are Unicode letters in lower case; a run of anything else is one blank, which n-grams may
begin or end with but not span. A language's profile comes from all its training texts. A
text's own profile is compared with each language's by the out-of-place distance: for each
of its n-grams how far the ranks lie apart, and the profile's length where the language
lacks it. The least distance wins; equal ones go to the language first by code point. The
score is one less the distance over the largest one possible.

NULL text, or text without a letter, is ``und`` with score 0, and so is every text when
nothing was learned. Rows without a language teach nothing. Ties of frequency go by the
n-gram's code points. Repeated rows are scored each, and taught each. Texts are worked off
in pieces, so memory does not follow their length. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE_SIZE = 300
PIECE_CHARS = 1 << 20
FLUSH_GRAMS = 1 << 20
UNKNOWN = "und"
BLANK = 1
SHIFT = np.int64(21)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text that cut no word."""
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers; letters take 21 bits each, the first the lowest."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    # one blank after each word, and one before the first
    ends = np.zeros(len(letter) + 1, bool)
    ends[1:] = letter
    ends[:-1] &= ~letter
    line = np.where(letter, codes, BLANK)
    line = np.concatenate([[BLANK], np.append(line, BLANK)[np.append(letter, False) | ends]])
    two = line[:-1] | line[1:] << SHIFT
    three = two[:-1] | line[2:] << SHIFT + SHIFT
    return np.concatenate([line[line != BLANK], two, three[line[1:-1] != BLANK]])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and how often each occurs."""
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for piece in _pieces(text or ""):
        found, times = np.unique(grams(piece), return_counts=True)
        keys.append(found)
        counts.append(times)
    return _merged(keys, counts) if len(keys) > 2 else (keys[-1], counts[-1])


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE_SIZE) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    return keys[np.lexsort((keys, -counts))[:size]]


def learn(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """Profiles from all rows of ``(lang, text)``.

    Tasks count n-grams of many texts together before anything is shuffled. ``size``
    n-grams a language come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        texts: dict[str, list[str]] = {}
        n_chars = 0

        def fold() -> None:
            for lang, own in texts.items():
                new = counted("\n".join(own))
                old = held.get(lang)
                held[lang] = _merged([old[0], new[0]], [old[1], new[1]]) if old else new
            texts.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                for low in range(0, len(keys), 10_000):
                    k, c = keys[low : low + 10_000], counts[low : low + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(c)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                texts.setdefault(lang, []).append(text)
                n_chars += len(text)
                if n_chars > PIECE_CHARS:
                    fold()
                    n_chars = 0
                    if sum(len(k) for k, _ in held.values()) > FLUSH_GRAMS:
                        yield from flush()
        fold()
        yield from flush()

    taught = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    totals = taught.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(by_count)).filter(F.col("place") <= size)
    profiles: dict[str, list] = {}
    for row in best.orderBy("lang", "place").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(own, np.int64) for lang, own in profiles.items()}


def nearest(own: np.ndarray, profiles: Mapping[str, tuple[np.ndarray, np.ndarray]], size: int) -> tuple[str, float]:
    """Language and score of a ranked profile; ``profiles`` hold sorted n-grams with ranks."""
    best = None
    places = np.arange(len(own))
    for lang in sorted(profiles):
        keys, ranks = profiles[lang]
        spots = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        out = np.where(keys[spots] == own, np.abs(ranks[spots] - places), size)
        distance = int(out.sum())
        if best is None or distance < best[1]:
            best = lang, distance
    return best[0], 1.0 - best[1] / (size * len(own))


def identify(docs: DataFrame, profiles: Mapping[str, np.ndarray], size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of the text."""
    sorted_profiles = {}
    for lang, own in profiles.items():
        order = np.argsort(own)
        sorted_profiles[lang] = own[order], order
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                own = ranked(*counted(text.as_py()), size)
                lang, score = nearest(own, sorted_profiles, size) if len(own) and sorted_profiles else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
            kept = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*(f.name for f in rest), "lang_pred", "score"])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "lang_pred string", "score double"])
    return docs.mapInArrow(work, kinds)


def fold_of(doc_id: Column, folds: int) -> Column:
    """Fixed fold of a row by its id; NULL for a row without one."""
    return F.crc32(doc_id.cast("string")) % folds
