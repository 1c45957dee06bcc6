import pytest
from pyspark.sql import functions as F

from helpers import od_rows, plan_of, values
from odmeter import samples
from odmeter.operators import enrich
from odmeter.schemas import KEY, PAIR

A = (-46.6, -23.5, -46.7, -23.6)
NEAR_A = (-46.6, -23.5, -46.7, -23.600004)
B = (-43.2, -22.9, -43.3, -22.8)
HOLE = (None, -22.9, -43.3, -22.8)


def route_table(spark, *rows):
    return spark.createDataFrame([(*p, *v) for p, v in rows], ", ".join(f"{c} double" for c in PAIR) + ", distance double, duration double")


def pairs_of(spark, *pairs):
    return od_rows(spark, [(f"k{i}", "2025-12", "a", i, p) for i, p in enumerate(pairs)])


def test_exact_first_then_four_decimals_then_none(spark):
    routes = route_table(spark, (A, (100.0, 10.0)))
    got = enrich.enrich_routes(pairs_of(spark, A, NEAR_A, B, HOLE), routes)
    assert values(got, KEY, "distance", "duration", "route_match") == [
        ("k0", 100.0, 10.0, "exact"),
        ("k1", 100.0, 10.0, "rounded"),
        ("k2", None, None, "no_route"),
        ("k3", None, None, "missing_coords"),
    ]
    assert values(enrich.route_rejects(got), KEY, "reason") == [("k2", "no_route"), ("k3", "missing_coords")]


def test_routes_never_multiply_rows_and_the_shortest_wins(spark):
    routes = route_table(spark, (A, (200.0, 1.0)), (A, (100.0, 20.0)), (A, (100.0, 10.0)), (NEAR_A, (50.0, 5.0)), (A, (None, 1.0)))
    got = enrich.enrich_routes(pairs_of(spark, A, A, NEAR_A), routes)
    assert values(got, KEY, "distance", "duration") == [("k0", 100.0, 10.0), ("k1", 100.0, 10.0), ("k2", 50.0, 5.0)]


def test_rows_that_are_exact_copies_all_come_out(spark):
    row = od_rows(spark, [("k", "2025-12", "a", 0, A)])
    copies = row.crossJoin(spark.range(500)).drop("id")
    got = enrich.enrich_routes(copies, route_table(spark, (A, (100.0, 10.0))))
    assert got.where("distance = 100").count() == 500


def test_work_list_holds_each_unrouted_pair_once(spark):
    rows = pairs_of(spark, A, B, B, NEAR_A, HOLE)
    assert values(enrich.distinct_od_pairs(rows, route_table(spark, (A, (1.0, 1.0))))) == [B]
    assert values(enrich.distinct_od_pairs(rows)) == sorted([A, B, NEAR_A], key=repr)


def test_pairs_may_come_from_the_scan(spark):
    rows = pairs_of(spark, A, B)
    routes = route_table(spark, (A, (1.0, 1.0)), (B, (2.0, 2.0)))
    got = enrich.enrich_routes(rows.where("order_number = 'k1'"), routes, pairs_of=rows)
    assert values(got, KEY, "distance") == [("k1", 2.0)]


def test_estimate_is_a_column_expression(spark):
    degree = pairs_of(spark, (0.0, 0.0, 1.0, 0.0), A[:2] + A[:2])
    got = enrich.enrich_geodesic(degree, speed_mps=10.0, detour=1.0)
    (_, metres, seconds), (_, zero, _) = values(got, KEY, "distance", "duration")
    assert metres == pytest.approx(111195.08, abs=0.1) and seconds == pytest.approx(metres / 10) and zero == 0
    plan = plan_of(enrich.enrich_geodesic(samples.od(spark, "/root/testdata/sf0.001")))
    assert "Python" not in plan and "Exchange" not in plan


def test_route_join_has_no_python_and_only_equi_joins(spark, sf):
    plan = plan_of(enrich.enrich_routes(samples.od(spark, sf), samples.routes(spark, sf)))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


class Failing:
    """Fails with the given texts in turn, then answers; records what it was asked."""

    def __init__(self, *texts):
        self.texts, self.asked = list(texts), []

    def __call__(self, *pair):
        self.asked.append(pair)
        if self.texts:
            raise RuntimeError(self.texts.pop(0))
        return 7, 3


PRECISE = (-46.612345, -23.512345, -46.712345, -23.612345)


def ask(route, connect=None, retries=5):
    waits = []
    answer = enrich.request_route(connect or (lambda: route), route, PRECISE, retries, waits.append)
    return answer, [round(w, 3) for w in waits]


def test_retry_rounds_and_waits_twice_as_long_each_time():
    route = Failing("timeout", "timeout")
    assert ask(route) == ((7.0, 3.0, 3, "rounded"), [0.2, 0.4])
    assert route.asked[0] == PRECISE and set(route.asked[1:]) == {(-46.6123, -23.5123, -46.7123, -23.6123)}


def test_no_route_ends_at_once_and_attempts_are_bounded():
    assert ask(Failing("No Route between points")) == ((None, None, 1, "no_route"), [])
    assert ask(Failing(*["busy"] * 9)) == ((None, None, 5, "retries_exhausted"), [0.2, 0.4, 0.8, 1.6])


def test_lost_connection_is_opened_again():
    second = Failing()
    first = Failing("Server DISCONNECTED", "must not be used again")
    assert ask(first, connect=lambda: second)[0] == (7.0, 3.0, 2, "rounded")
    assert len(first.asked) == 1 and len(second.asked) == 1


def test_provider_is_asked_once_per_distinct_pair(spark, tmp_path):
    log = str(tmp_path / "asked")

    def connect():
        def route(*pair):
            with open(log, "a") as out:
                out.write("x\n")
            if pair[0] == B[0]:
                raise ValueError("no route")
            return 10.0, 1.0

        return route

    rows = pairs_of(spark, A, A, A, B, HOLE, NEAR_A)
    got = enrich.enrich_with(rows, connect, callers=2, in_flight=4)
    assert got.count() == 6 and got.where("distance = 10").count() == 4
    assert values(enrich.route_rejects(got), KEY, "reason") == [("k3", "no_route"), ("k4", "missing_coords")]
    assert len(open(log).readlines()) == 3


def test_provider_is_not_asked_for_known_routes(spark):
    def connect():
        def route(*pair):
            assert pair == B
            return 5.0, 5.0

        return route

    got = enrich.enrich_with(pairs_of(spark, A, B, NEAR_A), connect, 2, routes=route_table(spark, (A, (1.0, 1.0))))
    assert values(got, KEY, "distance", "route_match") == [("k0", 1.0, "exact"), ("k1", 5.0, "exact"), ("k2", 1.0, "rounded")]


def test_hot_pair_and_hot_grid_cell(spark):
    """A third of the rows share a pair; another third are distinct pairs in one grid cell."""
    base = spark.range(3000).select(
        F.col("id").cast("string").alias(KEY),
        F.lit(A[0]).alias(PAIR[0]),
        F.lit(A[1]).alias(PAIR[1]),
        F.when(F.col("id") % 3 == 2, -60.0 + F.col("id") / 1000).otherwise(F.lit(A[2])).alias(PAIR[2]),
        F.when(F.col("id") % 3 == 1, A[3] + F.col("id") / 1e9).otherwise(F.lit(A[3])).alias(PAIR[3]),
    )
    got = enrich.enrich_routes(base, route_table(spark, (A, (1.0, 1.0))))
    assert values(got.groupBy("route_match").count()) == [("exact", 1000), ("no_route", 1000), ("rounded", 1000)]


def test_prepared_routes_answer_alike_and_are_not_shuffled(spark, sf, tmp_path):
    from odmeter.operators import route_index

    rows, routes = samples.od(spark, sf), samples.routes(spark, sf)
    index = route_index.write_routes(routes, str(tmp_path / "routes"), 8)
    columns = (KEY, "row_index", "distance", "duration", "route_match")
    assert values(enrich.enrich_routes(rows, index), *columns) == values(enrich.enrich_routes(rows, routes), *columns)
    again = route_index.open_routes(spark, str(tmp_path / "routes"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = enrich.pair_counts(rows)
        cells = route_index.with_grid(pairs).select(*route_index.GRID).distinct()
        for joined in (again.join_exact(pairs), cells.join(again.near, route_index.GRID)):
            plan = plan_of(joined)
            assert "SortMergeJoin" in plan
            indent = lambda line: len(line) - len(line.lstrip(" :+-"))
            lines = plan.splitlines()
            scan = max(k for k, x in enumerate(lines) if "FileScan parquet spark_catalog" in x)
            assert "Bucketed: true" in lines[scan]
            # what stands over the scan, up to the join: no exchange
            depth, above = indent(lines[scan]), []
            for line in reversed(lines[:scan]):
                if indent(line) < depth:
                    depth = indent(line)
                    above.append(line)
            over = above[: next(k for k, x in enumerate(above) if "SortMergeJoin" in x)]
            assert not any("Exchange" in x for x in over)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_zeros_of_either_sign_are_one_coordinate(spark):
    got = enrich.enrich_routes(pairs_of(spark, (0.0, -0.0, 1.0, 0.0)), route_table(spark, ((-0.0, 0.0, 1.0, -0.0), (5.0, 1.0))))
    assert values(got, "distance", "route_match") == [(5.0, "exact")]


def test_nothing_is_looked_up_on_a_replay(spark, tmp_path, monkeypatch):
    """All keys have landed: no pair reaches the route table."""
    from odmeter.plans import ingest
    from odmeter.context import RunContext
    from test_files import write_file

    source, landing, manifest = (str(tmp_path / n) for n in ("source", "landing", "manifest"))
    write_file(spark, source, "2025-12", "a.parquet", ["k1", "k2"], 1_764_561_600)
    looked, real = [], enrich._looked_up
    monkeypatch.setattr(enrich, "_looked_up", lambda pairs, index: looked.append(real(pairs, index)) or looked[-1])
    for _ in range(2):
        ingest.ingest_batch(spark, source, landing, str(tmp_path / f"manifest{len(looked)}"), RunContext.at("2025-12-02T04:00:00+00:00"),
                            ingest.by_routes(route_table(spark, ((1.5,) * 4, (1.0, 1.0)))))
    assert [x.count() for x in looked] == [1, 0]


def test_latest_good_answer_of_a_store_counts(spark, tmp_path):
    store = str(tmp_path / "answers")
    answers = [
        (*A, 900.0, 9.0, 1, "exact", "2025-12-01T00:00:00.000000"), (*A, 5.0, 1.0, 1, "exact", "2025-12-02T00:00:00.000000"),
        (*A, None, None, 5, "retries_exhausted", "2025-12-03T00:00:00.000000"), (*B, 7.0, 1.0, 1, "exact", None), (*B, None, None, 1, "no_route", "2025-12-01T00:00:00.000000"),
    ]
    spark.createDataFrame(answers, f"{enrich._ANSWER}, asked_at string").write.parquet(store)

    def connect():
        raise AssertionError("nothing is left to ask")

    got = enrich.ask_routes(enrich.od_pairs(pairs_of(spark, A, B)), connect, 2, store=store)
    assert values(got, "distance", "route_match") == [(5.0, "exact"), (None, "no_route")]


def test_each_step_reads_its_own_part_of_the_work(spark, tmp_path, monkeypatch):
    read, real = [], enrich.existing
    monkeypatch.setattr(enrich, "existing", lambda s, paths: read.extend(p for p in paths if "/step=" in p) or real(s, paths))
    pairs = enrich.od_pairs(pairs_of(spark, *[(float(k), 1.0, 2.0, 3.0) for k in range(40)]))
    got = enrich.ask_routes(pairs, lambda: lambda *pair: (pair[0], 1.0), 2, store=str(tmp_path / "answers"), pairs_per_commit=10)
    assert got.count() == 40 and len(read) == 4
    sizes = [spark.read.parquet(p).count() for p in real(spark, read)]
    assert sum(sizes) == 40 and max(sizes) < 40
