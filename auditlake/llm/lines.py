"""Line dedup over a corpus by a deletion-neighbourhood join, in native frames.

A line is taken with its white space collapsed and trimmed. Lines of ``min_words`` words or
more take part. One edit is a word put in, left out or replaced. A line is dropped if any
line before it, in the order of document id and line number, is within one edit of it; the
earliest always stays. Of shorter lines one edit is too much to tell copies by: with
``short_copies`` they are dropped if an equal line is before them, otherwise they stay.
Blank lines always stay.

Two lines within one edit share a variant: one line as it is and the other with one word
left out, or both with the word at the same place left out. Variants are hashed and
grouped. All lines that share a variant with the same place left out are within one edit
of one another, so each needs to meet only the earliest of its groups, and a group is
aggregated, never expanded into pairs. What a line is dropped for is verified on the words.

One edit leaves the first or the last half of a line as it was. So only lines that share a
half with another line can have a partner, and only those emit their variants. Texts are
split into lines once; between this and the writing of the results, rows of hashes and the
lines that emit variants are shuffled. A sketch of fixed size rules out most texts that lose
no line; the others are joined with the list of what goes by their id, in one form at
every size.

NULL text stays NULL, empty text stays empty. Rows without an id are left as they are and
count for no other row. Repeated rows are the same lines at the same place, and stay.
Input columns that clash with the added ``n_lines`` and ``n_dropped`` are replaced, and
names that begin with ``_gone`` or are ``_raw`` are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.native import hinted, key_sketch, may_hold, table

MIN_WORDS = 8


def normal_lines(text: Column) -> Column:
    """All lines of a text, white space collapsed to single spaces and trimmed."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(spaced, "\n"), lambda line: F.trim(line))


def _size(line: Column) -> Column:
    """Words of a normal line that is not empty."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _first(line: Column, n: Column) -> Column:
    return F.call_function("substring_index", line, F.lit(" "), n)


def _last(line: Column, n: Column) -> Column:
    return F.call_function("substring_index", line, F.lit(" "), -n)


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, body, line_no, line, n`` of lines of so many words; n is their words."""
    each = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("body"), F.posexplode(normal_lines(F.col("text"))).alias("line_no", "line")
    )
    # as many words can only be in a line of so many characters
    each = each.filter(F.length("line") >= 2 * min_words - 1)
    return each.withColumn("n", _size(F.col("line"))).filter(F.col("n") >= min_words)


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of both halves of a line, and of those that a line shorter by one has."""
    keys = []
    for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys.append(F.xxhash64(F.lit("first"), _first(line, half)))
        keys.append(F.xxhash64(F.lit("last"), _last(line, half)))
    return F.array_distinct(F.array(*keys))


def _variants(line: Column, n: Column) -> Column:
    """The line itself, at -1, and the line without each of its words."""
    whole = F.array(F.struct(F.lit(-1).alias("gap"), F.xxhash64(line).alias("variant")))
    less = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            i.alias("gap"),
            F.xxhash64(F.trim(F.concat(_first(line, i), F.lit(" "), _last(line, n - 1 - i)))).alias("variant"),
        ),
    )
    return F.concat(whole, less)


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word lists differ by one word put in, left out or replaced at most."""
    most = F.greatest(F.size(a), F.size(b))

    def agree(x: Column, y: Column) -> Column:
        differs = F.zip_with(x, y, lambda u, v: ~u.eqNullSafe(v))
        at = F.array_position(differs, F.lit(True))
        return F.when(at == 0, most).otherwise(at - 1)

    return (F.abs(F.size(a) - F.size(b)) <= 1) & (agree(a, b) + agree(F.reverse(a), F.reverse(b)) >= most - 1)


def _candidates(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """``lh, first`` of the distinct lines that share a half with another one."""
    halves = lines.select("lh", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("lh").alias("a"), F.max("lh").alias("b")).filter("a <> b")
    shared = table(shared.select("half"), "halves")
    return table(halves.join(shared, "half", "left_semi").select("lh").distinct().join(firsts.drop("times"), "lh"), "candidates")


def _texts(lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """``lh, line, n`` of candidate lines, each taken once from wherever it stands."""
    asked = may_hold(lines.select("lh", "line"), key_sketch(candidates, F.col("lh")), F.col("lh"))
    found = asked.groupBy("lh").agg(F.any_value("line").alias("line")).join(candidates.select("lh"), "lh", "left_semi")
    return table(found.withColumn("n", _size(F.col("line"))), "candidate-lines")


def _near(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """``lh, before``: place of the earliest line within one edit, where one is earlier."""
    variants = texts.select("lh", F.inline(_variants(F.col("line"), F.col("n"))))
    variants = table(variants, "variants")
    meeting = variants.groupBy("variant").agg(F.min("lh").alias("a"), F.max("lh").alias("b")).filter("a <> b")
    meeting = table(meeting.select("variant"), "meeting")
    placed = variants.join(meeting, "variant", "left_semi").join(candidates, "lh")
    placed = table(placed, "meetings")
    # the earliest line of each variant and gap; of those left whole; and of those with a gap
    entry = F.min(F.struct("first", "lh")).alias("e")
    gapped, entire = placed.filter("gap >= 0"), placed.filter("gap < 0")
    met = [
        gapped.join(gapped.groupBy("variant", "gap").agg(entry), ["variant", "gap"]),
        gapped.join(entire.groupBy("variant").agg(entry), "variant"),
        entire.join(gapped.groupBy("variant").agg(entry), "variant"),
    ]
    met = [
        m.filter("e.first < first").select("lh", F.col("e.lh").alias("other"), F.col("e.first").alias("before"))
        for m in met
    ]
    pairs = met[0].unionByName(met[1]).unionByName(met[2]).distinct()
    words = texts.select("lh", F.split("line", " ").alias("words"))
    other = words.select(F.col("lh").alias("other"), F.col("words").alias("other_words"))
    near = pairs.join(words, "lh").join(other, "other")
    return near.filter(within_one_edit(F.col("words"), F.col("other_words"))).groupBy("lh").agg(F.min("before").alias("before"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, *, short_copies: bool = False) -> DataFrame:
    """``docs`` without the dropped lines, with ``n_lines`` and ``n_dropped``."""
    bare = docs.select("doc_id", "text")
    # a line without halves is compared as a whole only, by its hash
    long = F.col("n") >= min_words
    halves = F.when(long, _half_keys(F.col("line"), F.col("n")))
    lines = _lines(bare, 1 if short_copies else min_words).select(
        "doc_id", "body", "line_no", F.xxhash64("line").alias("lh"), halves.alias("halves"), F.when(long, F.col("line")).alias("line")
    )
    lines = table(lines, "lines")
    firsts = lines.groupBy("lh").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("times")
    )
    firsts = table(firsts, "firsts")
    candidates = _candidates(lines, firsts)
    near = _near(_texts(lines, candidates), candidates)
    again = firsts.filter("times > 1").select("lh", F.col("first").alias("before"))
    limits = table(again.unionByName(near).groupBy("lh").agg(F.min("before").alias("before")), "limits")
    dropped = lines.join(limits, "lh").filter(F.struct("doc_id", "line_no") > F.col("before"))
    dropped = table(
        dropped.select(F.col("doc_id").alias("_gone_id"), F.col("body").alias("_gone_body"), "line_no"), "dropped"
    )
    gone = dropped.groupBy("_gone_id", "_gone_body").agg(F.collect_set("line_no").alias("_gone"))

    clash = [c for c in docs.columns if c.lower() in ("n_lines", "n_dropped", "_raw", "_gone", "_gone_id", "_gone_body")]
    docs = docs.drop(*clash)
    told = hinted(docs, key_sketch(dropped, F.xxhash64("_gone_id")), F.xxhash64("doc_id"), "_loses")
    same = (F.col("doc_id") == F.col("_gone_id")) & (F.xxhash64("text") == F.col("_gone_body"))
    lose = told.filter("_loses").join(gone, same, "left").select(*docs.columns, "_gone")
    joined = told.filter("NOT _loses").select(*docs.columns, F.lit(None).cast("array<int>").alias("_gone")).unionByName(lose)
    # a column of its own, so that it is split once and not for each line
    joined = joined.withColumn("_raw", F.when(F.col("_gone").isNotNull(), F.split("text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_raw") - 1), F.col("_gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get("_raw", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left).alias("text")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return joined.select(
        *[text if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(breaks + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
