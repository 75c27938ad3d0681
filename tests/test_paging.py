"""Limits, pages and bounded batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditlake.operators import metrics, paging, selection


@pytest.mark.parametrize(
    ("limit", "expected"),
    [("", 1000), ("abc", 1000), (None, 10000), (0, 10000), ("0", 10000), (20000, 10000), ("500", 500), (10000, 10000)],
)
def test_limit_rules(limit, expected):
    assert paging.effective_limit(limit) == expected


def test_negative_limit_is_refused():
    with pytest.raises(ValueError):
        paging.effective_limit(-1)


@pytest.mark.parametrize(("offset", "expected"), [(None, 0), (-5, 0), (0, 0), (7, 7)])
def test_offset_rules(offset, expected):
    assert paging.effective_offset(offset) == expected


@pytest.fixture
def ticks(spark):
    """1000 events over ten hours, a third of them at one time; some share an id too."""
    hour = F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id") % 10)
    created = F.format_string("2024-01-01T%02d:00:00.000Z", hour.cast("int"))
    return spark.range(1000, numPartitions=7).select(
        F.format_string("%04d", F.col("id") - F.col("id") % 2).alias("id"), created.alias("created")
    )


@pytest.mark.parametrize("offset", [0, 5, 120, 340, 341, 777, 990, 5000])
def test_deep_page_equals_shallow_page(ticks, monkeypatch, offset):
    shallow = paging.sorted_events(ticks).offset(offset).limit(30).collect()
    monkeypatch.setattr(paging, "MAX_LIMIT", 100)
    assert paging.page(ticks, 30, offset).collect() == shallow


def test_pages_after_one_another_are_all_rows(ticks):
    rows = ticks.dropDuplicates()
    expected, found, last = paging.sorted_events(rows).collect(), [], None
    while part := paging.page_after(rows, last, 130).collect():
        found += part
        last = part[-1].created, part[-1].id
    assert found == expected


def test_bounded_batch_takes_whole_ties(ticks):
    bounded = paging.bounded_batch(ticks, 300).rows
    rows = bounded.collect()
    last = max(r.created for r in rows)
    assert len(rows) >= 300
    assert len(rows) == ticks.filter(F.col("created") <= last).count()
    assert last == "2024-01-01T04:00:00.000Z"


def test_bounded_batch_of_nothing(ticks):
    assert paging.bounded_batch(ticks.filter("false"), 10).rows.isEmpty()
    assert metrics.next_position(ticks.filter("false")).first().next_checkpoint is None


def test_pages_keep_duplicates(ticks):
    assert paging.append_pages(ticks, ticks.limit(10)).count() == 1010


def test_caught_up_compares_with_the_effective_limit(ticks):
    assert metrics.total_and_caught_up(ticks, None).first() == (1000, True)
    assert metrics.total_and_caught_up(ticks, "1000").first() == (1000, False)


def odd_keys(spark, n=3_000):
    """Numbers and text with NULLs, a key that a third of all rows share, and repeats."""
    number = F.when(F.col("id") % 3 == 0, 17).when(F.col("id") % 7 != 0, F.xxhash64("id") % 500)
    word = F.when(F.col("id") % 5 != 0, F.concat(F.lit("w"), (F.xxhash64("id") % 40).cast("string")))
    return spark.range(n, numPartitions=6).select(number.alias("number"), word.alias("word"))


@pytest.mark.parametrize("few", [0, 50, 10_000])
@pytest.mark.parametrize("place", [0, 1, 299, 1_400, 1_777, 2_999, 3_000])
def test_the_nth_key_is_that_of_a_sort(spark, few, place):
    rows = odd_keys(spark)
    ordered = [tuple(r) for r in rows.orderBy("number", "word").collect()]
    found = selection.nth_key(rows, [F.col("number"), F.col("word")], place, few)
    if place >= len(ordered):
        assert found is None
    else:
        assert found.key == ordered[place] and found.before == ordered.index(ordered[place])


def test_selection_of_nothing(spark):
    assert selection.nth_key(odd_keys(spark, 0), [F.col("number")], 0) is None


@pytest.mark.parametrize("offset", [0, 5, 120, 340, 341, 777, 990, 999, 5000])
@pytest.mark.parametrize("few", [0, 10_000])
def test_pages_beyond_the_shallow_part(ticks, monkeypatch, offset, few):
    expected = paging.sorted_events(ticks).offset(offset).limit(30).collect()
    monkeypatch.setattr(selection, "FEW_ROWS", few)
    assert paging.page(ticks, 30, offset, shallow=-1).collect() == expected


def test_deep_pages_of_times_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW_ROWS", 10)
    rows = odd_keys(spark, 500).withColumn("created", F.timestamp_seconds(F.col("number")).cast("timestamp_ntz"))
    for offset in (3, 100, 200, 480):
        expected = rows.orderBy("created", "word").offset(offset).limit(25).collect()
        assert paging.page(rows, 25, offset, tiebreak="word", shallow=0).collect() == expected


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_large_bounds_hold_no_rows_in_one_task(spark, monkeypatch):
    rows = spark.range(30_000, numPartitions=4).selectExpr("timestamp_seconds(id % 20000) AS created")
    taken = []
    real = type(rows).limit
    monkeypatch.setattr(type(rows), "limit", lambda self, n: taken.append(n) or real(self, n))
    bounded = paging.bounded_batch(rows, 12_000)
    assert max(taken) <= selection.FEW_ROWS
    assert "TakeOrdered" not in plan_of(bounded.rows) and "Sort" not in plan_of(bounded.rows)
    # the times below 10 000 are there twice
    assert bounded.rows.count() == 12_000 and bounded.rows.agg(F.max("created")).first()[0].second == 59
    assert paging.bounded_batch(rows, 40_000).rows.count() == 30_000


def test_few_passes_where_many_rows_share_a_key(spark, monkeypatch):
    """The rows of one key used to be drawn together, so that a pass cut at one key only."""
    rows = spark.range(40_000, numPartitions=4).select((F.col("id") % 700).alias("number"))
    drawn, real = [], type(rows).limit
    monkeypatch.setattr(type(rows), "limit", lambda self, n: drawn.append(n) or real(self, n))
    for place in (5, 12_000, 31_234):
        drawn.clear()
        # each key is there 57 or 58 times
        found = selection.nth_key(rows, [F.col("number")], place, few=0)
        assert found.before <= place < found.before + 58 and len(drawn) <= 4
        assert found.before == rows.filter(F.col("number") < found.key[0]).count()
