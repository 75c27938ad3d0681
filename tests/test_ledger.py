"""Batch ingest by file: late files, unsettled events, crashes and bounds."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditlake import fixtures as fx
from auditlake.sources.raw import RAW_EVENT
from auditlake.streaming import ledger as by_file
from auditlake.streaming.ledger import FileLedger, RawFiles, ingest_files
from auditlake.streaming.loading import LoadJob

DAY = "2024-01-{:02d}T{:02d}:00:00.000Z"


def auth(n, created=DAY.format(5, 10), **more):
    return {"id": str(n), "type": "AUTH", "created": created, **more}


def put(folder, name, *events):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


@pytest.fixture
def case(spark, tmp_path, monkeypatch):
    """A folder of JSON lines, what its runs did, and the files each of them opened."""

    class Case:
        raw = tmp_path / "raw events+1"
        job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT)
        files = RawFiles(str(tmp_path / "raw events+1"), "json")
        opened: list[set[str]] = []

        def run(self, now=fx.NOW, **options):
            return ingest_files(self.files, self.job, FileLedger(spark, str(tmp_path / "ledger")), now, **options)

        def ids(self):
            rows = spark.read.parquet(self.job.shared_location())
            return sorted((r[0] for r in rows.select("data.id").collect()), key=int)

        def side(self):
            return Counter(json.loads(r.event)["id"] for r in spark.read.parquet(self.job.rejected_location()).collect())

    made, load = Case(), by_file.load_batch
    made.opened = []

    def noted(rows, *more):
        made.opened.append({f.rsplit("/", 1)[1] for f in rows.inputFiles()})
        return load(rows, *more)

    monkeypatch.setattr(by_file, "load_batch", noted)
    return made


def test_a_run_opens_new_files_only(case):
    put(case.raw, "a.json", auth(1), auth(2))
    assert case.run().transformed == 2
    assert case.run() is None
    # behind the position, in a new file
    put(case.raw, "b c.json", auth(3, DAY.format(2, 1)), auth(4))
    assert case.run().transformed == 2
    put(case.raw, "d%20.json", auth(5))
    case.run()
    assert case.opened == [{"a.json"}, {"b%20c.json"}, {"d%2520.json"}]
    assert case.ids() == ["1", "2", "3", "4", "5"]
    assert case.run() is None


def test_repeated_bad_events_all_go_aside(case):
    put(case.raw, "a.json", auth(1), auth(2, "soon"), auth(2, "soon"), {"id": "3"}, auth(9, "soon", type="UNMAPPED"))
    done = case.run()
    assert (done.transformed, done.rejected) == (1, 3)
    put(case.raw, "b.json", auth(2, "soon"), auth(2, "soon"), auth(2, "soon"))
    assert case.run().rejected == 3
    assert case.run() is None
    assert case.side() == {"2": 5, "3": 1} and case.ids() == ["1"]


def test_unsettled_events_are_taken_later_and_once(case):
    put(case.raw, "a.json", auth(1, DAY.format(10, 8)), auth(2, DAY.format(10, 11)), auth(3, DAY.format(10, 12)), auth(4, "soon"))
    put(case.raw, "b.json", auth(5, DAY.format(9, 0)))
    # one hour has to pass, and the bound itself has not settled
    assert case.run("2024-01-10T12:00:00Z").transformed == 2
    assert case.run("2024-01-10T12:00:00Z") is None
    assert case.run("2024-01-10T12:30:00Z").transformed == 1
    assert case.run("2024-01-11T12:00:00Z").transformed == 1
    assert case.run("2024-01-12T12:00:00Z") is None
    assert case.opened == [{"a.json", "b.json"}, {"a.json"}, {"a.json"}]
    assert case.ids() == ["1", "2", "3", "5"] and case.side() == {"4": 1}


@pytest.mark.parametrize("at", ["load_batch", "commit"])
def test_a_crash_repeats_the_plan(case, monkeypatch, at):
    put(case.raw, "a.json", auth(1), auth(2, "soon"))
    place = by_file if at == "load_batch" else FileLedger
    real = getattr(place, at)

    def crash(*args):
        real(*args)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(place, at, crash)
    with pytest.raises(RuntimeError):
        case.run()
    monkeypatch.setattr(place, at, real)
    # what has arrived since is for the next run
    put(case.raw, "b.json", auth(3), auth(2, "soon"))
    assert case.run().transformed == 1
    assert case.run().transformed == 1
    assert case.run() is None
    assert case.ids() == ["1", "3"] and case.side() == {"2": 2}


def test_bounded_runs_take_everything_once(case):
    put(case.raw, "a.json", *[auth(n, DAY.format(5, n // 10)) for n in range(40)])
    assert case.run(limit=15, bounded=True).transformed == 20
    # late ones come first now
    put(case.raw, "b.json", *[auth(100 + n, DAY.format(1 + n // 5, 3)) for n in range(30)])
    sizes = []
    while done := case.run(limit=12, bounded=True):
        sizes.append(done.transformed)
    # the events of the fourth day and a half are between those of the first file
    assert sum(sizes) == 50 and sizes[0] == 15
    assert sorted(map(int, case.ids())) == [*range(40), *range(100, 130)]


def test_a_replaced_file_is_a_new_one(case):
    put(case.raw, "a.json", auth(1))
    case.run()
    put(case.raw, "a.json", auth(2), auth(3))
    assert case.run().transformed == 2
    assert case.ids() == ["1", "2", "3"]


def test_nothing_there(case):
    case.raw.mkdir()
    assert case.run() is None
    put(case.raw, "a.json", auth(1, DAY.format(30, 23)))
    assert case.run().transformed == 0
    assert case.run("2024-02-01T00:00:00Z").transformed == 1


def test_open_bodies_by_file(spark, tmp_path):
    put(tmp_path / "in", "a.json", auth(1), auth(2, "soon"), {"id": "3"})
    job = LoadJob(fx.demo_mapping(), str(tmp_path / "lake"), fx.TENANT, variant_column="body", on_bad="side")
    files = RawFiles(str(tmp_path / "in"), variant_column="body")
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    done = ingest_files(files, job, ledger, fx.NOW)
    assert (done.transformed, done.rejected) == (1, 2)
    assert ingest_files(files, job, ledger, fx.NOW) is None


def test_undecided_conditions_are_counted(spark, tmp_path):
    put(tmp_path / "in", "a.json", auth(1, actor={"name": 7}), auth(2, actor={"name": True}), auth(3, actor={"name": "x"}))
    for one_scan in (True, False):
        job = LoadJob(fx.demo_mapping(), str(tmp_path / f"lake{one_scan}"), fx.TENANT, variant_column="body", one_scan=one_scan)
        done = ingest_files(RawFiles(str(tmp_path / "in"), variant_column="body"), job, FileLedger(spark, str(tmp_path / f"l{one_scan}")), fx.NOW)
        # two conditions of the mapping look at that name
        assert (done.transformed, done.undecided) == (3, 4)


def test_side_rows_are_looked_for_only_if_there_are_any(spark, tmp_path):
    """Bad values of open bodies are counted in the pass that writes."""
    jobs = []
    for name, value in (("good", "LOGOUT"), ("bad", ["LOGOUT"])):
        put(tmp_path / name, "a.json", auth(1, operation=value), auth(2, operation="LOGOUT"))
        spark.sparkContext.setJobGroup(name, name)
        job = LoadJob(fx.demo_mapping(), str(tmp_path / f"lake-{name}"), fx.TENANT, variant_column="body", on_bad="side")
        raw = spark.read.option("singleVariantColumn", "body").json(str(tmp_path / name))
        done = by_file.load_batch(raw, job, 0, "t")
        assert (done.transformed, done.rejected) == ((2, 0) if name == "good" else (1, 1))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[0] < jobs[1] and not (tmp_path / "lake-good" / "rejected").exists()


def test_listing_reads_no_content(spark, tmp_path):
    put(tmp_path / "in" / "day=1", "a.json", auth(1))
    listed = RawFiles(str(tmp_path / "in"), "json").listed(spark)
    assert "content:binary" not in listed._jdf.queryExecution().executedPlan().toString()
    row = listed.first()
    assert row.path.endswith("in/day=1/a.json") and row.size > 0
    assert RawFiles(str(tmp_path / "in"), "json", RAW_EVENT).scan(spark, [row.path]).select(F.col(by_file.FILE_COLUMN)).first()[0] == row.name


def test_bounds_of_a_run_read_the_time_once(spark):
    """A filter computes each mention of a parsed time again."""
    after, until = "2024-01-05T00:00:00.000000Z", "2024-01-06T00:00:00.000000Z"
    times = by_file._Times(LoadJob(fx.demo_mapping(), "/nowhere", fx.TENANT), "type")
    created = ["2024-01-05T00:00:00Z", "2024-01-05T00:00:00.000001Z", until, "2024-01-06T00:00:00.000001Z", "0001-01-01", "9999-12-31", "soon", None]
    rows = spark.createDataFrame([("AUTH", c) for c in created] + [(None, created[0]), ("UNMAPPED", created[1])], "type string, created string")
    new, again = times.settled(None, until, after), times.settled(after, until, "")
    assert str(new).count("created") == str(again).count("created") == 1
    taken = lambda test: [tuple(r) for r in rows.filter(test).collect()]
    assert taken(again) == [("AUTH", created[1]), ("AUTH", until)]
    assert taken(new) == [("AUTH", created[1]), ("AUTH", until), ("AUTH", "soon"), ("AUTH", None), (None, created[0])]
    assert taken(times.settled(until, after, "")) == []
