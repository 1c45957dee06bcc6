from pyspark.sql import functions as F

from helpers import values
from odmeter.reports import quality, runlog

# Log lines in the published form.
LOG = [
    ("2025-12-01_20251201_040000_success.log", 1, "2025-12-01 04:00:05 - --- INICIANDO PIPELINE VIA @REBOOT ---"),
    ("2025-12-01_20251201_040000_success.log", 2, "2025-12-01 04:10:15 - ⚠️  Removidas 45,123 duplicatas do arquivo fonte!"),
    ("2025-12-01_20251201_040000_success.log", 3, "2025-12-01 04:15:20 - ✅ Partição 2025-12 concluída. Total: 6,176,922 registros."),
    ("2025-12-01_20251201_040000_success.log", 4, "2025-12-01 04:15:21 - 📊 Total processado: 6,176,922 registros"),
    ("2025-12-01_20251201_040000_success.log", 5, "2025-12-01 04:15:36 - --- FIM DA EXECUÇÃO AUTOMÁTICA ---"),
    ("2025-12-01_20251201_040000_success.log", 6, ""),
    ("2025-11-15_040000_osrm_timeout.log", 1, "2025-11-15 04:00:30 - ⏳ Aguardando o servidor na porta 5000..."),
    ("2025-11-15_040000_osrm_timeout.log", 2, "2025-11-15 04:05:30 - ❌ TIMEOUT: servidor não respondeu após 60 tentativas."),
]


def log(spark, rows=LOG):
    return spark.createDataFrame(rows, "file_name string, line_no int, line string")


def test_run_log_stats(spark):
    stats = {r["file_name"]: r for r in runlog.run_log_stats(log(spark)).collect()}
    good, bad = stats[LOG[0][0]], stats[LOG[-1][0]]
    assert (good["total_processed"], good["n_months"], good["n_errors"], good["n_warnings"]) == (6176922, 1, 0, 1)
    assert (good["start_time"], good["end_time"]) == ("2025-12-01 04:00:05", "2025-12-01 04:15:36")
    assert (good["status"], good["run_date"]) == ("success", "2025-12-01")
    assert (bad["total_processed"], bad["n_months"], bad["n_errors"], bad["n_warnings"]) == (0, 0, 1, 0)
    assert bad["status"] == "osrm_timeout"
    assert values(runlog.run_log_months(log(spark)), "line_no", "month") == [(3, "2025-12")]


def test_every_status_in_both_name_forms(spark):
    names = [f"2025-12-01_{t}_{s}.log" for s in runlog.STATUSES for t in ("040000", "20251201_040000")]
    frame = spark.createDataFrame([(n,) for n in [*names, "notes.log"]], "n string")
    got = [r["s"] for r in frame.select(runlog.run_status(F.col("n")).alias("s")).collect()]
    assert got == [s for s in runlog.STATUSES for _ in range(2)] + ["unknown"]


def test_last_total_wins_and_a_line_can_be_both(spark):
    lines = ["t - Total processado: 1,000", "t - ❌ WARNING", "t - Total processado: 2,500", "t - Total processado: none"]
    row = runlog.run_log_stats(log(spark, [("f_success.log", i, x) for i, x in enumerate(lines)])).first()
    assert (row["total_processed"], row["n_errors"], row["n_warnings"]) == (2500, 1, 1)


def test_messages_are_cut_and_the_rest_is_counted(spark):
    rows = [("f.log", i, f"t - ERROR {i} " + "x" * 300) for i in range(7)]
    rows += [("f.log", 100 + i, f"t - WARNING {i} " + "y" * 300) for i in range(4)]
    rows += [("f.log", 200 + i, f"t - Partição 2025-{i + 1:02d} concluída") for i in range(6)]
    row = runlog.top_messages(log(spark, rows)).first()
    assert [m[:11] for m in row["errors"]] == [f"t - ERROR {i}" for i in range(5)] and len(row["errors"][0]) == 150
    assert len(row["warnings"]) == 3 and len(row["warnings"][0]) == 100
    assert row["months"] == [f"2025-{i + 1:02d}" for i in range(5)]
    assert (row["more_errors"], row["more_warnings"], row["more_months"]) == (2, 1, 1)


def test_logger_prefix(spark):
    rows = [("f", 0, "2025-12-01 04:00:05,123 - WARNING - text - more"), ("f", 1, "2025-12-01 04:00:05 - plain")]
    assert values(runlog.clean_lines(log(spark, rows)), "line") == [("2025-12-01 04:00:05 - plain",), ("text - more",)]


def test_log_files_keep_line_order(spark, tmp_path):
    from odmeter.sources.logs import SPLIT_ORDER, read_run_logs

    for name in {n for n, _, _ in LOG}:
        (tmp_path / name).write_text("\n".join(line for n, _, line in LOG if n == name) + "\n", encoding="utf-8")
    stats = runlog.run_log_stats(read_run_logs(spark, str(tmp_path)), order=SPLIT_ORDER)
    assert values(stats, "status", "start_time", "end_time", "total_processed") == [
        ("osrm_timeout", "2025-11-15 04:00:30", "2025-11-15 04:05:30", 0),
        ("success", "2025-12-01 04:00:05", "2025-12-01 04:15:36", 6176922),
    ]


def test_line_order_holds_over_splits(spark, tmp_path):
    from odmeter.sources.logs import SPLIT_ORDER, read_run_logs

    (tmp_path / "2025-12-01_040000_success.log").write_text("".join(f"{i:06d} - line\n" for i in range(20_000)))
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "20000")
    try:
        lines = read_run_logs(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        ordered = [r["line"] for r in lines.orderBy(*SPLIT_ORDER).collect()]
        row = runlog.run_log_stats(lines, SPLIT_ORDER).first()
    finally:
        spark.conf.set(conf, before)
    assert ordered == sorted(ordered) and len(ordered) == 20_000
    assert (row["start_time"], row["end_time"]) == ("000000", "019999")


def test_published_month_of_runs(spark):
    """30 runs, two failures after 2 and 4 hours: 93.33 %, 15 days between failures, 3 hours to recovery."""
    rows = [(f"2025-11-{d:02d}", {15: "osrm_timeout", 20: "container_restart"}.get(d, "success"), {15: 2.0, 20: 4.0}.get(d)) for d in range(1, 31)]
    runs = spark.createDataFrame(rows, "run_date string, status string, recovery_hours double")
    assert tuple(quality.availability_report(runs).first()) == (30, 28, 2, 93.33, 15.0, 3.0)
    assert values(quality.failures_by_type(runs)) == [("container_restart", 1), ("osrm_timeout", 1)]
    calm = quality.availability_report(runs.where("status = 'success'")).first()
    assert (calm["mtbf_days"], calm["mttr_hours"]) == (None, None)


def test_runs_of_logs(spark):
    runs = runlog.runs_of(runlog.run_log_stats(log(spark)))
    assert tuple(quality.availability_report(runs).first())[:3] == (2, 1, 1)


def test_quality_counts_null_nan_and_zero(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (5.0,)], "distance double")
    assert tuple(quality.quality_counts(rows).first()) == (4, 2, 1)


def test_throughput():
    assert quality.throughput(63_769_436, 6851) == 9308.05
    assert quality.throughput(1, 0) is None


def test_success_share_counts_requests_only(spark):
    rows = spark.createDataFrame([(1.0, "exact"), (None, "no_route"), (None, "missing_coords")], "distance double, route_match string")
    assert tuple(quality.unrouted_rate(rows).first()) == (2, 1, 50.0)
