"""Line dedup against a comparison of all lines, on a whole small table."""

from __future__ import annotations

import re
from collections import defaultdict

from auditlake.llm import lines, queries
from conftest import SMALL_DIR


def near(a, b):
    """One word put in, left out or replaced at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    n, m = len(a), min(len(a), len(b))
    p = next((i for i in range(m) if a[i] != b[i]), m)
    s = next((i for i in range(m) if a[-1 - i] != b[-1 - i]), m)
    del n
    return p + s >= max(len(a), len(b)) - 1


def brute(rows, min_words=lines.MIN_WORDS):
    found, out = [], {}
    by_size = defaultdict(list)
    for doc_id, text in sorted(rows):
        keep = []
        for line in text.split("\n"):
            words = re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line).strip(" ").split(" ")
            if len(words) >= min_words:
                gone = any(near(words, w) for k in (-1, 0, 1) for w in by_size[len(words) + k])
                by_size[len(words)].append(words)
                if gone:
                    continue
            keep.append(line)
        out[doc_id] = "\n".join(keep)
    del found
    return out


def test_whole_small_table_equals_all_lines(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    rows = lines.dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in rows} == expected
    assert sum(r.n_dropped for r in rows) > 0 and rows[0].__fields__ == [*docs.columns, "n_lines", "n_dropped"]


def test_edits_ties_and_odd_rows(spark):
    base = "a b c d e f g h i j"
    texts = [
        base,
        f"{base}\nshort line",
        "a b c d e f g h i",
        "x b c d e f g h i j\na b c d e f g h i j k",
        "a b c d  X f g\th i j ",
        "b a c d e f g h i j",
        "a b c d e f g h\na b c d e f g h",
        "",
        "\n\n",
        "short line\nshort line",
        "a a a a a a a a a\na a a a a a a a a a\na a a a a a a a a a a",
        " ".join(f"w{i}" for i in range(3000)) + "\n" + " ".join(f"w{i}" for i in range(3000) if i != 1500),
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (99, None), (None, base)], "doc_id bigint, text string")
    found = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert found == brute(rows) | {99: None, None: base}


def test_repeated_rows_clashing_columns_and_no_rows(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, text, "y")], "doc_id bigint, text string, n_lines string")
    found = sorted(tuple(r) for r in lines.dedup_lines(docs).collect())
    assert found == [(1, text, 1, 0), (1, text, 1, 0), (2, "", 1, 1)]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def without_short_copies(rows):
    """What is left by comparing all lines, with copies of shorter lines gone too."""
    seen, out = set(), {}
    # only shorter lines are looked at, and these are all still there
    for doc_id, text in sorted(brute(rows).items()):
        keep = []
        for line in text.split("\n"):
            normal = re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line).strip(" ")
            if normal and len(normal.split(" ")) < lines.MIN_WORDS:
                if normal in seen:
                    continue
                seen.add(normal)
            keep.append(line)
        out[doc_id] = "\n".join(keep)
    return out


def test_copies_of_short_lines_go(spark):
    base = "a b c d e f g h i j"
    rows = [
        (1, f"{base}\nAll rights  reserved.\n\none"),
        (2, f"{base}\nAll rights reserved.\n\none"),
        (3, "All rights reserved!\none\ttwo"),
        (4, " one two \none\n\nnew"),
    ]
    docs = spark.createDataFrame([*rows, (None, "one")], "doc_id bigint, text string")
    found = {r.doc_id: (r.text, r.n_dropped) for r in lines.dedup_lines(docs, short_copies=True).collect()}
    assert {k: v[0] for k, v in found.items()} == without_short_copies(rows) | {None: "one"}
    assert found[2] == ("", 3) and found[3][1] == 0 and found[4] == ("\nnew", 2)


def test_query_drops_short_copies_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text")
    expected = without_short_copies([(r.doc_id, r.text) for r in docs.collect()])
    found = {r.doc_id: r.text for r in queries.op3_line_dedup(spark, SMALL_DIR).collect()}
    assert found == expected and found != brute([(r.doc_id, r.text) for r in docs.collect()])


def test_only_texts_that_may_lose_lines_are_joined(spark, monkeypatch):
    """One form at every size: no list is broadcast for its length, and texts that a sketch
    of fixed size rules out stay where they are."""
    base = "a b c d e f g h i j"
    docs = spark.createDataFrame([(i, f"{base} {i}\nown line of {i} with some more words {i}\n{base} same") for i in range(50)], "doc_id bigint, text string")
    done = lines.dedup_lines(docs, short_copies=True)
    optimized = done._jdf.queryExecution().optimizedPlan().toString()
    # the sketch is the only thing that is broadcast by a hint
    assert optimized.count("strategy=broadcast") == 2 and "Union" in optimized
    expected = {r.doc_id: r.text for r in done.collect()}
    assert expected == without_short_copies([(r.doc_id, r.text) for r in docs.collect()])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.doc_id: r.text for r in lines.dedup_lines(docs, short_copies=True).collect()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
