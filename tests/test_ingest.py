import os

import pytest
from pyspark.sql import functions as F

from helpers import values
from odmeter.context import RunContext
from odmeter.plans import bookmark, ingest, maintain, work
from odmeter.schemas import KEY, MONTH
from odmeter.sources import files
from odmeter.streaming.ingest import stream_ingest
from test_files import write_file

DAY = 86_400
DEC_1 = 1_764_561_600  # 2025-12-01T04:00:00Z


def clock(day):
    return RunContext.at(f"{day}T04:00:00+00:00")


class Store:
    """A source, a landing table and a manifest in one temporary folder."""

    def __init__(self, spark, root):
        self.spark = spark
        self.source, self.landing, self.manifest = (f"{root}/{n}" for n in ("source", "landing", "manifest"))

    def put(self, month, name, keys, mtime):
        write_file(self.spark, self.source, month, name, keys, mtime)

    def run(self, day, enrich=None, **options):
        opts = ingest.IngestOptions(**options)
        by = enrich or ingest.by_estimate()
        return ingest.ingest_batch(self.spark, self.source, self.landing, self.manifest, clock(day), by, opts)

    def stream(self, day, checkpoint="stream"):
        stream_ingest(
            self.spark, self.source, self.landing, f"{self.landing}_{checkpoint}", ingest.by_estimate(),
            manifest=self.manifest, clock=lambda: clock(day), max_files=1,
        ).awaitTermination()

    def landed(self, *columns):
        return values(files.read_landing(self.spark, self.landing), *(columns or ("year", "month", KEY)))

    def state(self):
        rows = bookmark.bookmark_state(bookmark.read_manifest(self.spark, self.manifest)).collect()
        return {r[MONTH]: (r["completed"], r["checkpoint"] is not None) for r in rows}


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.put("2025-11", "a.parquet", ["k1", "k2", "k1"], DEC_1 - 5 * DAY)
    s.put("2025-11", "b.parquet", ["k2", "k3"], DEC_1 - 4 * DAY)
    s.put("2025-12", "a.parquet", ["k1", None], DEC_1)
    return s


NOV = [("2025", "11", k) for k in ("k1", "k2", "k3")]
DEC = [("2025", "12", "k1"), ("2025", "12", None)]


def test_first_run_lands_unique_keys_per_month(store):
    report = store.run("2025-12-01")
    assert store.landed() == sorted(NOV + DEC, key=repr)
    assert report.rows == 5 and report.quality["zero_distances"] == 5 and report.rows_per_second > 0
    assert [(t.month, t.mode) for t in report.tasks] == [("2025-11", work.HISTORICAL), ("2025-12", work.CURRENT)]
    assert store.state() == {"2025-11": (True, False), "2025-12": (False, True)}


def test_lineage(store):
    store.run("2025-12-01")
    assert set(store.landed("ingestion_date", "processing_timestamp", "source_file")) == {
        ("2025-12-01", "2025-12-01T04:00:00.000000", "a.parquet"),
        ("2025-12-01", "2025-12-01T04:00:00.000000", "b.parquet"),
    }


def test_manifest_has_one_row_per_file_with_its_landed_rows(store, spark):
    store.run("2025-12-01")
    rows = bookmark.read_manifest(spark, store.manifest).withColumn("name", F.substring_index("file_path", "/", -1))
    assert values(rows, MONTH, "name", "mode", "rows") == [
        ("2025-11", "a.parquet", "HISTORICAL", 2), ("2025-11", "b.parquet", "HISTORICAL", 1),
        ("2025-12", "a.parquet", "INCREMENTAL_CURRENT", 2),
    ]


def test_repeated_run_reads_nothing_new(store):
    store.run("2025-12-01")
    before = store.landed()
    assert store.run("2025-12-01").rows == 0 and store.landed() == before


def test_crash_between_write_and_commit_adds_no_rows(store, monkeypatch):
    monkeypatch.setattr(ingest, "append_manifest", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError):
        store.run("2025-12-01")
    monkeypatch.undo()
    before = store.landed()
    assert store.state() == {}
    assert store.run("2025-12-02").rows == 0
    assert store.landed() == before and store.state()["2025-11"] == (True, False)


def test_failed_write_moves_no_checkpoint(store, monkeypatch):
    monkeypatch.setattr(ingest, "write_landing", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        store.run("2025-12-01")
    assert store.state() == {}


def test_late_file_of_the_previous_month_is_found(store, spark):
    """On the first of January a file arrives in December's directory; December still has its checkpoint."""
    store.run("2025-12-31")
    store.put("2025-12", "late.parquet", ["k9", "k1"], DEC_1 + 31 * DAY)
    store.put("2026-01", "a.parquet", ["k1"], DEC_1 + 31 * DAY)
    report = store.run("2026-01-01")
    assert [(t.month, t.mode) for t in report.tasks] == [("2025-12", work.PREVIOUS), ("2026-01", work.CURRENT)]
    assert report.rows == 2
    # Two months on, December is run in full once more and then closed; nothing is added.
    aged = store.run("2026-02-01")
    assert [(t.month, t.mode) for t in aged.tasks] == [("2025-12", work.HISTORICAL), ("2026-01", work.PREVIOUS)]
    assert aged.rows == 0 and store.state()["2025-12"] == (True, False)
    changes = maintain.dedupe_months(spark, store.landing, aged.months)
    assert not any(c.rewritten for c in changes)


def test_month_in_which_all_rows_are_dropped_is_still_committed(store):
    store.run("2025-12-01")
    store.put("2025-12", "dup.parquet", ["k1", "k1"], DEC_1 + DAY)
    assert store.run("2025-12-02").rows == 0
    store.put("2025-12", "new.parquet", ["k4"], DEC_1 + 2 * DAY)
    report = store.run("2025-12-03")
    assert report.rows == 1 and report.committed == ["2025-12"]


def test_historical_month_without_parquet_is_closed(store):
    os.makedirs(f"{store.source}/2025-10")
    open(f"{store.source}/2025-10/readme.txt", "w").write("empty month")
    store.run("2025-12-01")
    assert store.state()["2025-10"] == (True, False)


def test_incremental_month_without_new_files_is_left_alone(store, spark):
    store.run("2025-12-01")
    rows = bookmark.read_manifest(spark, store.manifest).count()
    store.run("2025-12-02")
    assert bookmark.read_manifest(spark, store.manifest).count() == rows


def test_checkpoint_stops_at_the_first_bad_file(store):
    with open(f"{store.source}/2025-12/bad.parquet", "wb") as out:
        out.write(b"PAR1 no parquet PAR1")
    os.utime(f"{store.source}/2025-12/bad.parquet", (DEC_1 + DAY, DEC_1 + DAY))
    store.put("2025-12", "c.parquet", ["k7"], DEC_1 + 2 * DAY)
    report = store.run("2025-12-03", tolerant=True)
    assert report.held_back == ["2025-12"] and report.committed == ["2025-11"]
    assert ("2025", "12", "k7") in store.landed()
    os.remove(f"{store.source}/2025-12/bad.parquet")
    store.put("2025-12", "bad.parquet", ["k6"], DEC_1 + DAY)
    again = store.run("2025-12-04", tolerant=True)
    assert again.rows == 1 and again.held_back == [] and ("2025", "12", "k6") in store.landed()


def test_empty_file_of_another_month_is_not_held_back(store):
    store.put("2025-11", "empty.parquet", [], DEC_1 - 3 * DAY)
    with open(f"{store.source}/2025-12/bad.parquet", "wb") as out:
        out.write(b"PAR1 no parquet PAR1")
    os.utime(f"{store.source}/2025-12/bad.parquet", (DEC_1 + DAY, DEC_1 + DAY))
    report = store.run("2025-12-03", tolerant=True)
    assert report.held_back == ["2025-12"] == report.partly and report.committed == ["2025-11"]
    assert store.state() == {"2025-11": (True, False), "2025-12": (False, True)}


def test_tolerant_run_looks_at_new_files_only(store, monkeypatch):
    store.run("2025-12-01")
    store.put("2025-12", "c.parquet", ["k7"], DEC_1 + 2 * DAY)
    seen = []
    real = ingest.unread_files
    monkeypatch.setattr(ingest, "unread_files", lambda spark, delta, paths, only: seen.append(paths) or real(spark, delta, paths, only))
    assert store.run("2025-12-03", tolerant=True).rows == 1
    assert seen == [[f"{store.source}/2025-12"]]


@pytest.mark.parametrize("month", ["2025-11", "2025-12"])
def test_column_drift_in_any_month_stops_the_run_before_anything_is_written(store, month):
    from odmeter.schemas import PAIR
    from test_files import write_file

    write_file(store.spark, store.source, month, "drift.parquet", ["k9"], DEC_1, columns=PAIR[:3])
    with pytest.raises(Exception, match="drift.parquet"):
        store.run("2025-12-01")
    assert store.landed() == [] and store.state() == {}


def test_run_that_is_cut_off_goes_on_after_its_last_step(store, monkeypatch):
    real, steps = ingest.write_landing, []

    def second_fails(*args):
        steps.append(1)
        if len(steps) == 2:
            raise OSError("disk")
        real(*args)

    monkeypatch.setattr(ingest, "write_landing", second_fails)
    with pytest.raises(OSError):
        store.run("2025-12-01", commit_bytes=1)
    monkeypatch.undo()
    assert store.state() == {"2025-11": (True, False)}
    report = store.run("2025-12-01", commit_bytes=1)
    assert report.months == ["2025-12"] and store.landed() == sorted(NOV + DEC, key=repr)


def test_provider_is_not_asked_on_a_replay(store, tmp_path):
    log = str(tmp_path / "asked")

    def connect():
        def route(*pair):
            with open(log, "a") as out:
                out.write("x\n")
            return 1.0, 1.0

        return route

    by = ingest.by_provider(connect, callers=1)
    store.run("2025-12-01", enrich=by)
    asked = len(open(log).readlines())
    os.rename(store.manifest, f"{store.manifest}-lost")
    assert store.run("2025-12-02", enrich=by).rows == 0
    assert len(open(log).readlines()) == asked == 1


def test_answers_are_kept_for_the_next_run(spark, tmp_path):
    from odmeter.operators import enrich
    from odmeter.schemas import PAIR

    log, answers = str(tmp_path / "asked"), str(tmp_path / "answers")
    pairs = spark.createDataFrame([(float(k), 1.0, 2.0, 3.0) for k in range(12)], ", ".join(f"{c} double" for c in PAIR))

    def connect(good):
        def start():
            def route(*pair):
                with open(log, "a") as out:
                    out.write(f"{pair[0]}\n")
                if pair[0] not in good:
                    raise MemoryError("stop") if pair[0] == 99.0 else RuntimeError("busy")
                return pair[0], 1.0

            return route

        return start

    first = enrich.ask_routes(pairs.where("poc_longitude < 8"), connect(set(range(7))), 2, 2, 1, answers, 3)
    assert {(r[0], r["route_match"]) for r in first.collect()} == {(float(k), "exact") for k in range(7)} | {(7.0, "retries_exhausted")}
    second = enrich.ask_routes(pairs, connect(set(range(12))), 2, 2, 1, answers, 3)
    assert set(values(second, PAIR[0], "distance")) == {(float(k), float(k)) for k in range(12)}
    asked = [float(x) for x in open(log)]
    assert sorted(asked) == sorted([float(k) for k in range(12)] + [7.0])


def test_strict_run_fails_on_a_bad_file(store):
    with open(f"{store.source}/2025-12/bad.parquet", "wb") as out:
        out.write(b"PAR1 no parquet PAR1")
    with pytest.raises(Exception):
        store.run("2025-12-03")
    assert store.state() == {}


def test_truly_empty_month_directory(store):
    os.makedirs(f"{store.source}/2025-09")
    store.run("2025-12-01")
    assert store.state()["2025-09"] == (True, False)


def test_box_and_valid_copies_are_options(store):
    assert store.run("2025-12-01", bbox={"lat": (50.0, 60.0), "lon": (0.0, 10.0)}, prefer_valid=True).rows == 0
    assert store.state()["2025-11"] == (True, False)


def test_routing_function_feeds_a_run(store):
    def connect():
        return lambda *pair: (1234.0, 56.0)

    assert store.run("2025-12-01", enrich=ingest.by_provider(connect, callers=2)).rows == 5
    assert set(store.landed("distance", "duration")) == {(1234.0, 56.0)}


def test_route_table_feeds_a_run_and_unrouted_rows_do_not_land(store, spark):
    from odmeter.schemas import PAIR

    columns = ", ".join(f"{c} double" for c in PAIR) + ", distance double, duration double"
    none = spark.createDataFrame([], columns)
    report = store.run("2025-12-01", enrich=ingest.by_routes(none))
    assert report.rows == 0 and store.state()["2025-11"] == (True, False)
    one = spark.createDataFrame([(1.5, 1.5, 1.5, 1.5, 10.0, 2.0)], columns)
    store.put("2025-12", "next.parquet", ["k8"], DEC_1 + DAY)
    assert store.run("2025-12-02", enrich=ingest.by_routes(one)).rows == 1


def test_years_limit_the_run(store):
    store.put("2024-05", "a.parquet", ["z"], DEC_1 - 300 * DAY)
    assert store.run("2025-12-01", years=["2024"]).months == ["2024-05"]


def test_stream_lands_what_the_batch_lands(store, spark, tmp_path):
    store.run("2025-12-01")
    other = Store(spark, str(tmp_path / "other"))
    other.source = store.source
    other.stream("2025-12-01")
    assert other.landed() == store.landed()


def test_stream_reads_files_that_are_much_older_and_files_in_sub_folders(store, spark):
    store.stream("2025-12-01")
    store.put("2025-10", "aged.parquet", ["o1"], DEC_1 - 400 * DAY)
    store.put("2025-11/more", "deep.parquet", ["o2"], DEC_1 - 300 * DAY)
    store.stream("2025-12-02")
    assert store.landed() == sorted(NOV + DEC + [("2025", "10", "o1"), ("2025", "11", "o2")], key=repr)
    rows = bookmark.read_manifest(spark, store.manifest)
    assert values(rows.where("partition_month = '2025-11'"), "rows") == [(1,), (1,), (2,)]


def test_stream_restart_picks_up_only_new_files_also_late_ones(store):
    store.stream("2025-12-01")
    store.put("2025-11", "late.parquet", ["k3", "k5"], DEC_1 + DAY)
    store.stream("2025-12-02")
    assert store.landed() == sorted(NOV + DEC + [("2025", "11", "k5")], key=repr)
    # A lost stream checkpoint reads all files again and adds nothing.
    store.stream("2025-12-03", checkpoint="fresh")
    assert len(store.landed()) == 6
    assert store.state()["2025-11"] == (False, True)


def test_large_month_goes_on_inside_after_a_crash(store):
    """Historical and current month in units of one file; the run dies at its third unit and later goes on there."""
    for k in range(4):
        store.put("2025-11", f"c{k}.parquet", [f"n{k}", "k1", f"n{k - 1}"], DEC_1 - 3 * DAY + k)
        store.put("2025-12", f"c{k}.parquet", [f"d{k}", "k1", f"d{k - 1}"], DEC_1 + 10 + k)
    store.put("2025-12", "same.parquet", ["s1"], DEC_1 + 12)  # a file of the same time as another stays with it
    asked, plain = [], ingest.by_estimate()

    def dies_at(number):
        def enrich(rows, scanned):
            asked.append(sorted(r[0] for r in scanned.select("file_path").distinct().collect()))
            if len(asked) == number:
                raise OSError("killed")
            return plain(rows, scanned)

        return enrich

    for number in (3, 9):
        with pytest.raises(OSError):
            store.run("2025-12-03", dies_at(number), commit_bytes=1, unit_bytes=1)
        assert store.state().get("2025-11", (False,))[0] is (number == 9)
    report = store.run("2025-12-03", dies_at(0), commit_bytes=1, unit_bytes=1)
    assert report.rows > 0 and report.committed == ["2025-12"]
    names = [os.path.basename(p) for unit in asked for p in unit]
    # every file but those of the two units that died was read once
    assert len(names) == len({p for unit in asked for p in unit}) + len(asked[2]) + len(asked[8])
    assert [len(u) for u in asked].count(2) == 1
    whole = Store(store.spark, f"{store.landing}_whole")
    whole.source = store.source
    whole.run("2025-12-03")
    columns = ("year", "month", KEY, "source_file", "distance")
    assert store.landed(*columns) == whole.landed(*columns)
    assert store.state() == whole.state() == {"2025-11": (True, False), "2025-12": (False, True)}
    assert store.run("2025-12-03", commit_bytes=1, unit_bytes=1).rows == 0


def test_run_counts_come_from_the_write(store, monkeypatch):
    """No scan of the landing table counts rows: what is written is observed."""
    monkeypatch.setattr("odmeter.reports.quality.quality_counts", lambda *a: pytest.fail("counted again"))
    report = store.run("2025-12-01")
    assert report.quality == {"rows": 5, "nan_distances": 0, "zero_distances": 5} and report.rows == 5


@pytest.mark.parametrize("lost", ["commit", "manifest"])
def test_replayed_batch_commits_once(store, monkeypatch, lost):
    """The driver dies after the manifest was written, or after the rows were: the batch comes again."""
    from odmeter.streaming import ingest as streaming

    if lost == "manifest":
        monkeypatch.setattr(streaming, "append_manifest", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(Exception, match="killed"):
            store.stream("2025-12-02")
        monkeypatch.undo()
    else:
        store.stream("2025-12-02")
        commits = f"{store.landing}_stream/commits"
        for name in os.listdir(commits):
            os.remove(f"{commits}/{name}")
    store.stream("2025-12-05")
    manifest = bookmark.read_manifest(store.spark, store.manifest)
    assert values(manifest, MONTH, "rows") == [("2025-11", 1), ("2025-11", 2), ("2025-12", 2)]
    assert manifest.select("batch").distinct().count() == 3
    assert store.landed() == sorted(NOV + DEC, key=repr)
