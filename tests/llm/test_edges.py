"""Odd rows, empty tables, clashing columns: each has one defined result."""

from __future__ import annotations

import gzip
import hashlib
import heapq
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from auditlake.llm import chat, decontaminate, langid, mixing, native, quality, queries, tokens, toxicity, urls, warc
from auditlake.llm.oracles import ORACLES
from auditlake.llm.queries import HOSTILE, URL_RULES
from conftest import SMALL_DIR

LONG = " ".join(f"word{i % 977}" for i in range(2_500))
TEXTS = [None, "", " \n\t ", "one", "One one ONE", LONG, "é É ß 語 語 語", "a\nb\na\nb\n\n", "same text here", "same text here", "x" * 3_000_000]


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def docs_of(spark, texts=TEXTS, first=0):
    rows = [(first + i, t, ("en", None, "de")[i % 3], ("s1", None, "s2")[i % 3], i, "clash") for i, t in enumerate(texts)]
    return frame(spark, rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string")


# --- shared word hashes ---------------------------------------------------------


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
@pytest.mark.parametrize(("letters", "pattern"), [(tokens.BY_SPACE, r"[^\x20\x09-\x0D]+"), (tokens.BY_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(monkeypatch, piece, letters, pattern):
    monkeypatch.setattr(tokens, "PIECE_BYTES", piece)
    draw = random.Random(piece)
    texts = ["".join(draw.choices("abcAB  \n\t.é語-", k=draw.randrange(60))) for _ in range(80)] + ["", "abc", "ABC abc"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hashes, ends = tokens.hash_words(data, offsets, letters)
    words = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    assert [ends[i + 1] - ends[i] for i in range(len(texts))] == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


# --- the queries that SQL can express, on odd rows -------------------------------


def judged(spark, name, found, **tables):
    """Whether rows equal those of the query's SQL over these tables."""
    with duckdb.connect() as db:
        for table, rows in tables.items():
            db.register(table, rows.toArrow())
        expected = db.sql(ORACLES[name])
        order = sorted(found.columns)
        left = Counter(tuple(r[c] for c in order) for r in found.collect())
        right = Counter(tuple(r[expected.columns.index(c)] for c in order) for r in expected.fetchall())
    assert left == right


def test_quality_of_odd_rows(spark):
    docs = docs_of(spark)
    few = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 500_000)
    judged(
        spark,
        "op2_quality_rules",
        quality.judge(few).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        documents=few.select("doc_id", "text"),
    )
    assert quality.judge(docs.limit(0)).count() == 0
    assert quality.judge(docs).count() == len(TEXTS)


@pytest.mark.parametrize("hashes", [1, 3, 20])
def test_equal_windows_are_found_among_others_of_one_hash(spark, monkeypatch, hashes):
    monkeypatch.setattr(quality, "window_hash", lambda *words: F.shiftleft(F.pmod(F.xxhash64(*words), F.lit(hashes)), 40))
    draw = random.Random(hashes)
    texts = [" ".join(draw.choices("abcdef", k=draw.randrange(90))) for _ in range(40)] + ["a b c d a b c", "a a a a"]
    docs = docs_of(spark, texts)
    found = quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    judged(spark, "op2_quality_rules", found, documents=docs.select("doc_id", "text"))


def test_contamination_of_odd_rows(spark):
    item = "A b c d e f g h i j k l"
    short = "uno dos tres"
    texts = [*TEXTS[:-1], item.upper(), f"x {item} y {item[2:]}", "b-c.d e f g h i j", "zz uno DOS, tres uno dos", "a " * 500, item, item]
    docs = docs_of(spark, texts)
    docs = docs.unionByName(docs.filter(f"doc_id = {len(texts) - 1}")).unionByName(docs.limit(1).withColumn("text", F.lit(item)).withColumn("doc_id", F.lit(None).cast("bigint")))
    items = frame(spark, [(1, item), (2, short), (3, None), (4, ""), (5, "b c d e f g h i j"), (2, short), (6, "a a a a a a a a a a a a")], "item_id bigint, text string")
    names = F.array_join(F.sort_array(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    for bench in (items, items.limit(0)):
        found = decontaminate.contaminated(docs, bench).select(
            "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
        )
        judged(spark, "op6_decontaminate", found, documents=docs.select("doc_id", "text"), benchmark=bench)
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0



def test_items_without_id_hit_and_have_no_name(spark):
    item, other = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    docs = frame(spark, [(1, f"zz {item} zz"), (2, f"{other} {item}"), (3, "zz"), (4, other)], "doc_id bigint, text string")
    items = frame(spark, [(None, item), (None, item), (None, "uno dos"), (5, other)], "item_id bigint, text string")
    found = {r.doc_id: (r.n_hit, r.item_ids) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {1: (12, []), 2: (24, [5]), 3: (0, []), 4: (12, [5])}


@pytest.mark.parametrize("block_words", [1, 30, 4_000_000])
def test_items_without_id_count_as_in_sql(spark, monkeypatch, block_words):
    """Also where the items come to the tasks in many blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    item, other, short = "a b c d e f g h i j k l", "m n o p q r s t u v w x", "uno dos"
    texts = [f"zz {item} zz", f"{other} {item}", "zz", other, f"{item[6:]} {other} Uno, dos", f"{item} {item} {short}"]
    docs = frame(spark, [*enumerate(texts), (None, other)], "doc_id bigint, text string")
    items = frame(spark, [(None, item), (None, item), (None, short), (5, other), (6, other), (5, item), (7, "f g h i j k l m n o p")], "item_id bigint, text string")
    names = F.array_join(F.sort_array(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    found = decontaminate.contaminated(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
    judged(spark, "op6_decontaminate", found, documents=docs, benchmark=items)


def test_items_stay_out_of_the_rows_of_documents(spark):
    """Documents that share one passage with many items do not carry the items' words."""
    passage = " ".join(f"p{i}" for i in range(12))
    docs = frame(spark, [(i, f"{passage} d{i}") for i in range(60)], "doc_id bigint, text string")
    items = frame(spark, [(i, f"i{i} {passage} " + " ".join(f"t{i}x{k}" for k in range(500))) for i in range(60)], "item_id bigint, text string")
    found = decontaminate.contaminated(docs, items)
    assert {(r.n_hit, r.n_items) for r in found.collect()} == {(12, 60)}


# --- sketches -------------------------------------------------------------------


def test_sketches_keep_all_keys_and_few_others(spark):
    keys = spark.range(0, 30_000, 7)
    told = native.hinted(spark.range(30_000), native.key_sketch(keys, F.xxhash64("id")), F.xxhash64("id"), "hint")
    held = {r.id for r in told.filter("hint").collect()}
    assert held >= set(range(0, 30_000, 7)) and len(held) < 4_286 * 1.02 and told.count() == 30_000
    none = native.key_sketch(keys.limit(0), F.xxhash64("id"))
    assert native.may_hold(spark.range(5), none, F.xxhash64("id")).count() == 0


def test_rows_that_may_go_are_joined_alone(spark):
    rows = spark.range(1_000).select(F.when(F.col("id") != 3, F.col("id")).alias("k"), F.lit("long text").alias("text"))
    gone = spark.range(0, 1_000, 2).withColumnRenamed("id", "g")
    left = native.without(rows, gone, F.col("k") == F.col("g"), F.xxhash64("k"), F.xxhash64("g"))
    assert sorted(r.k or 3 for r in left.collect()) == list(range(1, 1_000, 2))


URLS = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en", "https://a.b.example.com/en/", "http://example.net/fr/1", "http://net/es/", "http://xnet/es/",
        "http://com", "http://com/", "http://com.", "http://.com/", "http://a..com/", "http://com:80/", "http://é.com/é", "x://y://com/", "http://example.com\n/en/", "http:///en/", "http://WWW.example.com/EN/"]


@pytest.mark.parametrize("rows_per_range", [1, 3, 8_000])
def test_urls_of_odd_rows_in_many_ranges(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(urls, "ROWS_PER_RANGE", rows_per_range)
    pages = frame(spark, [(i, u, "clash") for i, u in enumerate(URLS * 2)] + [(None, URLS[3], "clash"), (2**60 + 1, URLS[4], "clash")], "page_id bigint, url string, host string")
    rules = frame(spark, [*URL_RULES, ("com", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("", "/", "block")], "host string, path string, verdict string")
    judged(spark, "op4_url_filters", urls.judge(pages, rules), pages=pages.select("page_id", "url"))
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("rows_per_range", [1, 8_000])
def test_the_longest_rule_wins_over_the_innermost_host(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(urls, "ROWS_PER_RANGE", rows_per_range)
    rules = [("com", "/long/path/", "block"), ("a.com", "/", "allow"), ("b.a.com", "/long", "block"), ("a.com", "/long/p", "allow"), ("com", "/", "allow")]
    asked = [f"http://{host}com{path}" for host in ("", "a.", "b.a.", "x.b.a.", "z.") for path in ("", "/", "/long/path/x", "/long/p", "/longer")]
    pages = frame(spark, list(enumerate(asked)), "page_id bigint, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, frame(spark, rules, "host string, path string, verdict string")).collect()}
    for i, url in enumerate(asked):
        host, _, path = url.removeprefix("http://").partition("/")
        path = "/" + path if _ else ""
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert found[i] == (max(fits)[1:] if fits else (None, "allow")), url


def test_ranges_follow_the_rows_and_then_their_root(spark, monkeypatch):
    monkeypatch.setattr(urls, "ROWS_PER_RANGE", 10)
    monkeypatch.setattr(urls, "LINEAR_RANGES", 20)
    asked = spark.range(5_000).selectExpr("CAST(id AS STRING) AS key", "'' AS path", "id AS salt")
    assert len(urls._bounds(asked.limit(150))) == 14 and 80 <= len(urls._bounds(asked)) <= 99


def test_chats_of_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\b<s>[INST]\\<|end|>"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (2, None, None, None), (None, 0, "assistant", "no id"), (3, 0, "<|end|>", "語 é"), (4, 0, "assistant", "\\\\<\\s>" * 50)]
    table = frame(spark, [(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, body string")
    pair = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.to_variant_object(F.struct(F.lit(HOSTILE).alias("prompt"), F.lit(HOSTILE).alias("response"))).alias("body"))
    done = chat.format_rows(table).unionByName(chat.format_chats(pair))
    judged(spark, "op7_chat_formatting", chat.digest(done, "conv_id"), conversations=table.drop("body"))
    assert chat.format_rows(table.limit(0)).count() == 0
    control = [c for c in chat.CONTROL if c not in (chat.TURN, chat.TEXT, chat.END)]
    assert not any(c in r.formatted for r in done.collect() for c in control)


CHAT_ROWS = [(1, 0, "user", None), (1, 1, "assistant", "a<s>"), (1, 1, "assistant", "a<s>"), (2, None, None, None), (None, 0, "human", "no id")]


def chat_rows(spark, role, text, more=""):
    rows = [(*r, "clash") if more else r for r in CHAT_ROWS]
    return frame(spark, rows, f"conv_id bigint, turn bigint, `{role}` string, `{text}` string{more}")


@pytest.mark.parametrize(
    ("role", "text", "more", "layout"),
    [("role", "text", "", "turn_rows"), ("role", "content", ", body string", "message_rows"), ("from", "value", "", "dialogue_rows"),
     ("speaker", "text", "", None), ("role", "text", ", content string", None)],
)
def test_row_layouts_are_picked_by_fingerprint(spark, role, text, more, layout):
    done = chat.format_rows(chat_rows(spark, role, text, more))
    assert "variant" not in done._jdf.queryExecution().analyzed().toString().lower()
    rows = {r.conv_id: r for r in done.withColumn("turns", chat.parsed_turns(F.col("formatted"))).collect()}
    assert rows.keys() == {1, 2, None} and {r.layout for r in rows.values()} == {layout}
    if layout is None:
        assert {(r.formatted, r.loss_mask) for r in rows.values()} == {(None, None)}
        return
    named = "user" if layout == "dialogue_rows" else "human"
    assert [tuple(t) for t in rows[1].turns] == [("user", ""), ("assistant", "a<s>"), ("assistant", "a<s>")]
    assert [tuple(t) for t in rows[2].turns] == [("", "")] and [tuple(t) for t in rows[None].turns] == [(named, "no id")]


def test_marks_are_those_of_spark(spark):
    shapes = [chat.shape_of_paths(x.paths) for x in (*chat.LAYOUTS, *chat.ROW_LAYOUTS)]
    found = frame(spark, [(s,) for s in shapes], "s string").select("s", chat.fingerprint(F.col("s")).alias("mark")).collect()
    assert all(r.mark == chat.mark_of(r.s) for r in found) and len({r.mark for r in found}) == len(shapes)


@pytest.mark.parametrize("n", [1, 255, 256, 257, 3_000])
def test_masks_of_long_chats(spark, n):
    rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 1, 'assistant', 'user') AS role", "repeat('é<s>', CAST(id % 4 AS INT)) AS text")
    done = chat.format_rows(rows).first()
    whole = done.formatted.encode()
    texts = [whole[m.start : m.start + m.length].decode() for m in done.loss_mask]
    assert texts == ["é<\\s>" * (i % 4) for i in range(n) if i % 3 == 1]


def test_layouts_are_picked_by_fingerprint(spark):
    bodies = {
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": null}]}': ("messages", [("user", "q"), ("assistant", "")]),
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]}': ("dialogue", [("user", "q"), ("assistant", "a"), ("tool", "t")]),
        '{"response": "a", "prompt": "q"}': ("pair", [("user", "q"), ("assistant", "a")]),
        '{"instruction": "do", "input": "", "output": "done"}': ("instruction_input", [("user", "do"), ("assistant", "done")]),
        '{"instruction": "do", "input": "this", "output": 7}': ("instruction_input", [("user", "do\n\nthis"), ("assistant", "7")]),
        '{"system": "s", "prompt": "q", "response": "a"}': ("system_pair", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        '{"messages": []}': ("empty_messages", []),
        '{"other": 1}': (None, None),
        "[1]": (None, None),
    }
    frame_ = frame(spark, list(enumerate(bodies)), "n int, json string").select("n", F.try_parse_json("json").alias("body"))
    done = {r.n: r for r in chat.format_chats(frame_).withColumn("turns", chat.parsed_turns(F.col("formatted"))).collect()}
    for n, (layout, turns) in enumerate(bodies.values()):
        assert done[n].layout == layout
        assert (done[n].turns and [tuple(t) for t in done[n].turns]) == (turns or done[n].turns and [])


# --- WARC -----------------------------------------------------------------------


def test_archives_of_odd_pages(spark, tmp_path):
    big = "p" * 999 + "é"
    pages = [(1, None, None), (2, "http://x/ \r\ny", ""), (3, "u", big), (5, "u", big), (4, "u", big), (6, "u", "p" * 999), (7, "u", "p" * 999), (None, "u", "q" * 2000), (None, "u", "q" * 2000), (8, "u", "WARC/1.1\r\n\r\nx\r\n\r\n"), (9, "u", "z" * 3_000_000)]
    table = frame(spark, [(*p, "clash") for p in pages], "page_id bigint, url string, html string, value string")
    warc.write_monolithic(warc.page_records(table).coalesce(2), str(tmp_path / "whole"))
    n, size = warc.normalise(spark, str(tmp_path / "whole"), str(tmp_path / "members"))
    assert n == len(pages) and warc.normalise(spark, str(tmp_path / "members"), str(tmp_path / "again")) == (n, size)
    index = warc.read_index(spark, str(tmp_path / "members"))
    for row in index.collect():
        with open(tmp_path / "members" / row.archive, "rb") as archive:
            archive.seek(row.offset)
            assert gzip.decompress(archive.read(row.length)).startswith(b"WARC/1.1\r\n")
    found = warc.read_records(index, str(tmp_path / "members"), 3).collect()
    by_id = {r.record_id: r for r in found if r.record_id != "<urn:page:>"}
    for page_id, _, html in pages:
        if page_id is None:
            continue
        body, row = (html or "").encode(), by_id[f"<urn:page:{page_id}>"]
        assert row.declared_bytes == len(body) and row.declared_digest == "sha1:" + hashlib.sha1(body).hexdigest()
        assert (row.record_type, row.refers_to) == (("revisit", "<urn:page:5>") if page_id in (3, 4) else ("response", None))
        assert row.payload == (b"" if page_id in (3, 4) else body)
    assert [r.record_type for r in found if r.record_id == "<urn:page:>"] == ["response", "response"]


def test_archives_of_nothing_and_of_damage(spark, tmp_path):
    empty = frame(spark, [], "page_id bigint, url string, html string")
    warc.write_monolithic(warc.page_records(empty), str(tmp_path / "whole"))
    assert warc.normalise(spark, str(tmp_path / "whole"), str(tmp_path / "members")) == (0, 0)
    assert warc.read_records(warc.read_index(spark, str(tmp_path / "members")), str(tmp_path / "members"), 0).count() == 0
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for n, broken in enumerate((gzip.compress(record)[:-12], gzip.compress(record[:-6]), gzip.compress(b"nonsense\r\n\r\n"))):
        (tmp_path / f"{n}.gz").write_bytes(broken)
        with pytest.raises(ValueError, match=f"{n}.gz"):
            warc.normalise_file(str(tmp_path / f"{n}.gz"), str(tmp_path), "out.gz")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 38, 1 << 20])
def test_records_that_pieces_cut_anywhere(tmp_path, monkeypatch, size):
    blocks = [b"", b"hello", b"\r\n", b"\r\n\r\nWARC/1.1\r\n\r\n", b"last"]
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(b) + b for b in blocks]
    whole = b"".join(r + b"\r\n\r\n" for r in records)
    for cut in range(len(whole) + 1):
        assert [r for _, r in warc.records_of(iter([whole[:cut], b"", whole[cut:]]))] == records
    (tmp_path / "one.gz").write_bytes(gzip.compress(whole))
    monkeypatch.setattr(warc, "READ_BYTES", size)
    n, _ = warc.normalise_file(str(tmp_path / "one.gz"), str(tmp_path), "two.gz")
    assert n == len(records) and gzip.decompress((tmp_path / "two.gz").read_bytes()) == whole


# --- mixing ---------------------------------------------------------------------


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12_345])
def test_seats_go_to_the_highest_quotients(spark, seats):
    votes = {"a": 53_000.0, "b": 24_000.0, "c": 24_000.0, "d": 10.0, "e": 0.0, "f": 999.5}
    rows = frame(spark, list(votes.items()), "name string, v double")
    found = {r.name: r.quota for r in mixing.apportion(rows, "v", F.lit(seats), [], ["name"]).collect()}
    heap = [(-v, name, 1) for name, v in votes.items() if v]
    expected = dict.fromkeys(votes, 0)
    for _ in range(seats):
        _, name, n = heapq.heappop(heap)
        expected[name] += 1
        heapq.heappush(heap, (-votes[name] / (2 * n + 1), name, n + 1))
    assert found == expected


@pytest.mark.parametrize("shard_tokens", [500, 10**6])
def test_mix_of_odd_rows(spark, shard_tokens):
    texts = [*TEXTS, *[f"w{i} " * (i % 90) for i in range(300)]]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, ["twice over"], 5)).unionByName(docs_of(spark, ["twice over"], 5))
    rows = mixing.mix(docs, shard_tokens=shard_tokens).collect()
    assert len(rows) == len(texts) + 2
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s))
    goal, weights = dict.fromkeys(order, 0.0), dict(zip(order, (3, 1, 2), strict=False))
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    while open_:
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        goal |= {s: 2.0 * sizes[s] for s in full} if full else share
        left -= sum(2 * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    assert {s: round(t, 6) for s, t in target.items()} == {s: round(t, 6) for s, t in goal.items()}
    slack = 16 * (1 + -(-sum(sizes.values()) // shard_tokens))
    assert all(abs(taken[s] - target[s]) <= slack for s in order)
    again = mixing.mix(docs.repartition(5), shard_tokens=shard_tokens).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(docs.limit(3)).collect()} == {0}


@pytest.mark.parametrize("shard_tokens", [700, 500_000])
def test_what_is_taken_equals_a_plain_walk(spark, shard_tokens):
    """Documents of a shard in seeded order, as many words as its quota, round again."""
    docs = docs_of(spark, [f"w{i} " * (i * 7 % 90) for i in range(300)] + [None, "", "end"])
    rows = mixing.mix(docs, shard_tokens=shard_tokens).collect()
    words = sum(r.size for r in rows)
    n_shards = max(1, -(-words // shard_tokens))
    cells, goal = {}, {}
    for r in rows:
        cells.setdefault((r.source, (r.draw >> 20) % n_shards), []).append(r)
        goal[r.source] = r.target

    def seats(votes, n):
        """Sainte-Laguë, one seat after another."""
        won, order = dict.fromkeys(votes, 0), sorted(votes, key=lambda k: (k is None, k or ""))
        for _ in range(n if any(votes.values()) else 0):
            top = max(order, key=lambda k: (votes[k] / (2 * won[k] + 1), -order.index(k)))
            won[top] += 1
        return won

    blocks = seats(goal, int(sum(goal.values()) / 16 + 0.5))
    for source, own_blocks in blocks.items():
        sizes = {k[1]: sum(r.size for r in own) for k, own in cells.items() if k[0] == source}
        quotas = {str(k).zfill(9): v for k, v in sizes.items()}
        won = seats(quotas, own_blocks)
        for shard, total in sizes.items():
            left = min(16 * won[str(shard).zfill(9)], 2 * total)
            own = sorted(cells[source, shard], key=lambda r: (r.draw, r.doc_id, r.size))
            taken = Counter()
            while left and total:
                for at, r in enumerate(own):
                    step = min(left, r.size)
                    taken[at] += step
                    left -= step
            assert [r.taken for r in own] == [taken[at] for at in range(len(own))]


# --- language and toxicity ------------------------------------------------------


def test_profiles_equal_plain_counting(spark):
    texts = [("en", "The cat. THE cat"), ("en", "a cat"), ("de", "Die Katze"), (None, "none"), ("fr", None), ("es", "123 ...")]
    found = langid.learn(frame(spark, [(*t, "clash") for t in texts], "lang string, text string, score string"), 7)

    def plain(own):
        counts = Counter()
        for word in re.findall(r"[^\W\d_]+", " ".join(own).lower()):
            line = f"\x01{word}\x01"
            counts.update(sum(ord(c) << 21 * i for i, c in enumerate(line[k : k + n])) for n in (1, 2, 3) for k in range(len(line) - n + 1) if line[k : k + n] != "\x01")
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:7]]

    assert {k: v.tolist() for k, v in found.items()} == {"en": plain(["The cat. THE cat", "a cat"]), "de": plain(["Die Katze"])}


def test_choices_equal_those_of_plain_distances(spark):
    """Out-of-place distances, rank by rank, on whole texts of a table."""
    rows = [r for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "lang", "text").collect()]
    docs = frame(spark, [tuple(r) for r in rows], "doc_id bigint, lang string, text string")
    size = 60
    profiles = langid.learn(docs.filter("doc_id % 3 = 0"), size)
    found = {r.doc_id: r for r in langid.identify(docs.select("doc_id", "text"), profiles, size).collect()}
    for row in rows:
        counts = Counter()
        for word in re.findall(r"[^\W\d_]+", row.text.lower()):
            line = f"\x01{word}\x01"
            counts.update(sum(ord(c) << 21 * i for i, c in enumerate(line[k : k + n])) for n in (1, 2, 3) for k in range(len(line) - n + 1) if line[k : k + n] != "\x01")
        own = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]
        if not own:
            assert found[row.doc_id].lang_pred == "und"
            continue
        away = {}
        for lang, profile in profiles.items():
            place = {g: i for i, g in enumerate(profile.tolist())}
            away[lang] = sum(abs(place[g] - i) if g in place else size for i, g in enumerate(own))
        best = min(sorted(away), key=away.get)
        assert (found[row.doc_id].lang_pred, found[row.doc_id].score) == (best, pytest.approx(1 - away[best] / (size * len(own))))


def test_language_of_odd_rows(spark, monkeypatch):
    docs = docs_of(spark)
    profiles = {"a": langid.ranked(*langid.counted("one same text here")), "b": langid.ranked(*langid.counted("語 é"))}
    found = {r.doc_id: r for r in langid.identify(docs.select("doc_id", "text"), profiles).collect()}
    assert [found[i].lang_pred for i in range(9)] == ["und", "und", "und", "a", "a", found[5].lang_pred, "b", found[7].lang_pred, "a"]
    assert all(0 <= r.score <= 1 for r in found.values()) and found[0].score == 0
    assert {r.lang_pred for r in langid.identify(docs.select("doc_id", "text"), langid.learn(docs.limit(0))).collect()} == {"und"}
    whole = langid.counted(LONG)
    monkeypatch.setattr(langid, "PIECE_CHARS", 1000)
    pieces = langid.counted(LONG)
    assert dict(zip(*map(np.ndarray.tolist, whole), strict=True)).keys() == dict(zip(*map(np.ndarray.tolist, pieces), strict=True)).keys()


def test_toxicity_of_odd_rows_and_labels(spark):
    docs = docs_of(spark)
    none = frame(spark, [], "doc_id bigint, label int")
    assert toxicity.train(docs, none).net == 0.0
    one = frame(spark, [(1, 1), (2, 1), (None, 0), (3, None)], "doc_id bigint, label int")
    assert toxicity.train(docs, one).net == 1.0
    draw = random.Random(5)
    texts = [" ".join(draw.choices([f"w{i}" for i in range(400)], k=40)) + (" vile-word" if i % 2 else "") for i in range(120)]
    known = frame(spark, [(100 + i, i % 2) for i in range(120)], "doc_id bigint, label int")
    some = docs_of(spark, texts, 100)
    trained = toxicity.train(some, known)
    scored = {r.doc_id: r.score for r in toxicity.score(some.unionByName(docs).select("doc_id", "text"), trained.net).collect()}
    assert len(scored) == 120 + len(TEXTS) and all(0 <= s <= 1 for s in scored.values())
    assert sum((scored[100 + i] >= 0.5) == bool(i % 2) for i in range(120)) >= 114
    assert scored[0] == scored[1] == scored[2]
    assert toxicity.score(docs.limit(0).select("doc_id", "text"), trained.net).count() == 0


def test_thresholds_and_flags(spark):
    rows = frame(spark, [(0.3, "en"), (0.3, "de"), (0.6, None)], "s double, lang string")
    flags = rows.select(toxicity.flagged(F.col("s"), F.col("lang"), {"en": 0.2})).collect()
    assert [r[0] for r in flags] == [True, False, True]


def test_thresholds_are_found_in_the_natural_mix(spark, monkeypatch):
    """However few texts the fit draws, all labels are scored, by a network without them."""
    rows = [(i, f"w{i % 7} " * 5 + ("vile" if i % 10 == 0 else ""), "en", int(i % 10 == 0)) for i in range(1_000)]
    docs = frame(spark, [r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = frame(spark, [(r[0], r[3]) for r in rows], "doc_id bigint, label int")
    seen = []
    whole = toxicity.thresholds_by_language
    monkeypatch.setattr(toxicity, "thresholds_by_language", lambda scored: seen.extend(scored.collect()) or whole(scored))
    trained = toxicity.train(docs, labels, per_class=20)
    assert trained.texts == 40 and sorted(r.label for r in seen) == sorted(r[3] for r in rows)
    assert 0 < trained.thresholds["en"] < 1 and len(trained.net) == toxicity.MEMBERS
    two = labels.filter("doc_id IN (0, 1)")
    assert not isinstance(toxicity.train(docs, two).net, float)


def plain_odds(net, words):
    """One text's log odds, place by place."""
    vectors = [net.embedding[rows].mean(axis=0) for rows in words]
    pooled = []
    for width in toxicity.WIDTHS:
        for k in range(toxicity.FILTERS):
            best = 0.0
            for at in range(len(words) - width + 1):
                told = net.offsets[width][k] + sum(vectors[at + j] @ net.filters[width][j][:, k] for j in range(width))
                best = max(best, float(told))
            pooled.append(best)
    return float(np.array(pooled) @ net.out + net.bias[0] + net.shift)


def test_scores_equal_those_of_a_plain_loop():
    draw = np.random.default_rng(2)
    texts = ["", "one", "two words", "three short words", " ".join(draw.choice([f"w{i}" for i in range(9)], 40)), "", "end"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    buckets, ends = toxicity.word_buckets(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    nets = [toxicity.Network.fresh(seed) for seed in (1, 2)]
    nets[0].shift = nets[1].shift = 0.7
    scores = toxicity.score_of(nets, buckets, ends)
    for i in range(len(texts)):
        odds = np.mean([plain_odds(net, buckets[ends[i] : ends[i + 1]]) for net in nets])
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-5)


def test_toxicity_of_held_out_texts(spark):
    """Floors of the query on whole texts that it did not learn from."""
    folder = "/root/testdata/sf0.1"
    toxic = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = queries.op9_toxicity(spark, folder).filter("held_out").join(toxic, "doc_id").join(langs, "doc_id").toPandas()
    bad, good = rows[rows.toxic == 1], rows[rows.toxic == 0]
    ahead = (bad.score.values[:, None] > good.score.values[None]).mean()
    assert len(bad) > 50 and ahead >= 0.975 and (bad.predicted == 1).mean() >= 0.8
    assert good.flagged.mean() <= 0.02 and good.groupby("lang").flagged.mean().max() <= 0.05
    assert bad.flagged.mean() >= 0.8


def plain_threshold(rows):
    """The score halfway below the cut with the best F1; the highest of equals."""
    rows = sorted(rows, key=lambda r: -r[2])
    total, hits, best = sum(r[1] for r in rows), 0, (0, None)
    for k, (_, label, value) in enumerate(rows, 1):
        hits += label
        below = rows[k][2] if k < len(rows) else 0.0
        if 2 * hits / (k + total) > best[0]:
            best = 2 * hits / (k + total), (value + below) / 2
    return best[1]


def test_thresholds_of_counts_equal_those_of_scores(spark):
    rows = [("en", int(s > 0.6 or i % 9 == 0), float(s)) for i, s in enumerate(np.linspace(0, 1, 60))]
    rows += [("de", 0, 0.2), (None, 1, 0.9), ("fr", 1, 1.0), ("fr", 0, 0.0)]
    scored = frame(spark, rows, "lang string, label int, score double")
    assert toxicity.thresholds_by_language(scored, 30)[0] == {}
    found, common = toxicity.thresholds_by_language(scored, 1)
    assert found == {"en": plain_threshold([r for r in rows if r[0] == "en"]), "fr": 0.5}
    assert common == plain_threshold(rows)
    assert toxicity.thresholds_by_language(scored.limit(0)) == ({}, 0.5)


# --- pipeline -------------------------------------------------------------------


def test_stages_take_odd_rows_and_none(spark, small_dir):
    docs = docs_of(spark, TEXTS[:-1]).withColumn("size", F.lit("clash"))
    docs = docs.unionByName(docs.filter("doc_id = 5")).unionByName(docs.limit(4).withColumn("doc_id", F.lit(None).cast("bigint")))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, small_dir)
        if name != "mixing":
            assert found.columns == docs.columns
        assert found.count() <= docs.count()
        assert stage(spark, docs.limit(0), small_dir).count() == 0
