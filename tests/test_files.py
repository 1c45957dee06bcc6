import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, values
from odmeter.plans.work import CURRENT, HISTORICAL, MonthTask
from odmeter.schemas import KEY, LANDING, MONTH, OD, PAIR
from odmeter.sinks.landing import write_landing
from odmeter.sources import files
from odmeter.sources.paths import Folder


def write_file(spark, root, month, name, keys, mtime=None, columns=PAIR):
    """One Parquet file with a chosen name and modification time (seconds)."""
    rows = spark.createDataFrame([(k,) for k in keys], f"{KEY} string").select(KEY, *[F.lit(1.5).alias(c) for c in columns])
    raw = f"{root}/_raw_{month}_{name}"
    rows.coalesce(1).write.parquet(raw)
    part = next(n for n in os.listdir(raw) if n.endswith(".parquet"))
    os.makedirs(f"{root}/{month}", exist_ok=True)
    os.rename(f"{raw}/{part}", f"{root}/{month}/{name}")
    if mtime is not None:
        os.utime(f"{root}/{month}/{name}", (mtime, mtime))
    return f"{root}/{month}/{name}"


@pytest.fixture
def source(spark, tmp_path):
    root = str(tmp_path / "source")
    write_file(spark, root, "2024-12", "a.parquet", ["x"], 100)
    write_file(spark, root, "2025-01", "b.parquet", ["p", "q"], 300)
    write_file(spark, root, "2025-01", "a.parquet", ["p"], 200)
    os.makedirs(f"{root}/not-month")
    open(f"{root}/2025-01/notes.txt", "w").write("no parquet")
    return root


def test_months_and_years(spark, source):
    assert values(files.list_partitions(spark, source)) == [("2024-12",), ("2025-01",)]
    assert values(files.list_partitions(spark, source, ["2025"])) == [("2025-01",)]
    with pytest.raises(FileNotFoundError):
        files.list_partitions(spark, source + "-missing")


def test_listing_has_sizes_times_and_only_parquet_when_asked(spark, source):
    everything = files.list_files(spark, source, recursive=True)
    assert values(everything, "file_name") == [("a.parquet",), ("a.parquet",), ("b.parquet",), ("notes.txt",)]
    parquet = files.list_files(spark, files.month_glob(source), files.PARQUET_ONLY)
    assert values(parquet.select(MONTH, "file_name", F.unix_seconds("file_time").alias("t"))) == [
        ("2024-12", "a.parquet", 100), ("2025-01", "a.parquet", 200), ("2025-01", "b.parquet", 300),
    ]
    assert parquet.where("file_size <= 0").count() == 0


def test_rows_carry_file_columns(spark, source):
    rows = files.read_od_months(spark, source, ["2025-01"])
    assert values(rows, KEY, MONTH, "source_file", "row_index") == [
        ("p", "2025-01", "a.parquet", 0), ("p", "2025-01", "b.parquet", 0), ("q", "2025-01", "b.parquet", 1),
    ]


def test_missing_source_column_raises(spark, source):
    write_file(spark, source, "2025-02", "a.parquet", ["x"], columns=PAIR[:3])
    with pytest.raises(ValueError, match=PAIR[3]):
        files.read_od_months(spark, source, ["2025-02"])


@pytest.mark.parametrize("short", ["a.parquet", "z.parquet"])
def test_column_that_one_of_several_files_lacks_raises_with_its_name(spark, source, short):
    write_file(spark, source, "2025-02", short, ["x"], columns=PAIR[:3])
    write_file(spark, source, "2025-02", "m.parquet", ["y"])
    with pytest.raises(Exception, match=f"{PAIR[3]} in file .*{short}"):
        files.read_od_months(spark, source, ["2025-02"]).collect()
    with pytest.raises(Exception, match=f"{PAIR[3]} in file .*{short}"):
        files.read_od_months(spark, source, ["2025-02"], schema=OD).collect()


def test_files_below_a_month_directory_belong_to_it(spark, source):
    write_file(spark, source, "2025-01/deep/er", "c.parquet", ["r"], 250)
    assert values(files.read_od_months(spark, source, ["2025-01"]), KEY, MONTH) == [
        ("p", "2025-01"), ("p", "2025-01"), ("q", "2025-01"), ("r", "2025-01"),
    ]
    task = MonthTask("2025-01", CURRENT, 200_000_000)
    assert values(files.list_delta(spark, source, [task]), "file_name") == [("b.parquet",), ("c.parquet",)]


def test_delta_skips_whole_files_and_is_strict(spark, source):
    def names(task):
        return values(files.read_delta(spark, source, [task]).select("source_file").distinct())

    us = 1_000_000
    assert names(MonthTask("2025-01", CURRENT, 200 * us)) == [("b.parquet",)]
    assert names(MonthTask("2025-01", CURRENT, 199 * us)) == [("a.parquet",), ("b.parquet",)]
    assert names(MonthTask("2025-01", CURRENT, None)) == [("a.parquet",), ("b.parquet",)]
    assert names(MonthTask("2025-01", HISTORICAL, 300 * us)) == [("a.parquet",), ("b.parquet",)]
    nothing = files.read_delta(spark, source, [MonthTask("2025-01", CURRENT, 300 * us)])
    assert nothing.rdd.getNumPartitions() == 0
    assert values(files.list_delta(spark, source, [MonthTask("2025-01", CURRENT, 200 * us)]), "file_name") == [("b.parquet",)]


def test_delta_reads_only_needed_columns(spark, source):
    plan = plan_of(files.read_delta(spark, source, [MonthTask("2025-01", CURRENT, 200)]).select(KEY))
    assert f"ReadSchema: struct<{KEY}:string>" in plan


def test_tolerant_read_names_what_it_left_out(spark, source):
    good = files.month_glob(source)
    with open(f"{source}/2025-01/broken.parquet", "wb") as out:
        out.write(b"PAR1 this is no parquet PAR1")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        files.read_od_months(spark, source, ["2025-01"], schema=OD).collect()
    rows = files.read_od_months(spark, source, ["2025-01"], schema=OD, tolerant=True)
    assert rows.count() == 3
    unread = files.unread_files(spark, files.list_files(spark, good, files.PARQUET_ONLY), [good])
    assert values(unread, "file_name") == [("broken.parquet",)]
    assert files.empty_files(spark, [good]).count() == 0


def test_damaged_page_behind_a_good_footer_counts_as_unread(spark, source):
    path = write_file(spark, source, "2025-01", "damaged.parquet", [f"key-{i}" for i in range(5000)])
    data = bytearray(open(path, "rb").read())
    data[4:400] = b"\xff" * 396
    open(path, "wb").write(data)
    crc = f"{source}/2025-01/.damaged.parquet.crc"
    assert not os.path.exists(crc)
    listing = files.list_files(spark, files.month_glob(source), files.PARQUET_ONLY)
    assert values(files.unread_files(spark, listing, [files.month_glob(source)]), "file_name") == [("damaged.parquet",)]


def test_empty_file_is_not_damaged(spark, source):
    write_file(spark, source, "2025-01", "empty.parquet", [])
    listing = files.list_files(spark, files.month_glob(source), files.PARQUET_ONLY)
    with open(f"{source}/2024-12/broken.parquet", "wb") as out:
        out.write(b"PAR1 this is no parquet PAR1")
    listing = files.list_files(spark, files.month_glob(source), files.PARQUET_ONLY)
    unread = files.unread_files(spark, listing, [files.month_glob(source)])
    empty = files.empty_files(spark, [files.month_glob(source)])
    assert values(unread, "file_name") == [("broken.parquet",), ("empty.parquet",)]
    assert values(unread.join(empty, "file_path", "left_anti"), "file_name") == [("broken.parquet",)]


def test_tolerant_scan_decodes_the_source_once(spark, source):
    path = write_file(spark, source, "2025-01", "damaged.parquet", [f"key-{i}" for i in range(5000)])
    data = bytearray(open(path, "rb").read())
    data[4:400] = b"\xff" * 396
    open(path, "wb").write(data)
    paths = [files.month_glob(source)]
    staged = files.stage_scan(files.read_od_months(spark, source, schema=OD, tolerant=True))
    listing = files.with_rows_read(files.list_files(spark, paths, files.PARQUET_ONLY), staged)
    unread = files.unread_files(spark, listing, paths)
    assert values(unread, "file_name") == [("damaged.parquet",)]
    # of the source only footers are read: no column of it is decoded
    schemas = [line for line in plan_of(unread).split("FileScan parquet")[1:] if "/scan-" not in line]
    assert schemas and all("ReadSchema: struct<>" in line for line in schemas)


def test_large_file_without_rows_is_empty(spark, source, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    wide = pa.schema([(f"column_{k:06d}_{'x' * 40}", pa.string()) for k in range(12_000)])
    path = f"{source}/2025-01/wide.parquet"
    pq.write_table(wide.empty_table(), path)
    assert os.path.getsize(path) > 1 << 20
    assert [os.path.basename(r[0]) for r in files.empty_files(spark, [files.month_glob(source)]).collect()] == ["wide.parquet"]


def landing_frame(spark, *rows):
    return spark.createDataFrame(rows, LANDING)


def row(key, month="12", year="2025", name="f", day="2025-12-01"):
    return (key, 1.0, 2.0, day, f"{day}T00:00:00.000000", name, year, month)


def test_landing_layout_and_text_months(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing_frame(spark, row("a", "01"), row("b", "12")), path)
    assert os.path.isdir(f"{path}/year=2025/month=01")
    assert values(files.read_landing(spark, path), KEY, "year", "month") == [("a", "2025", "01"), ("b", "2025", "12")]
    assert values(files.read_existing_keys(spark, path, ["2025-01", "2031-01"])) == [("2025-01", "a")]
    assert files.read_existing_keys(spark, path, ["2031-01"]).count() == 0


def test_append_never_clobbers_and_block_size_is_an_upper_bound(spark, tmp_path):
    path = str(tmp_path / "landing")
    for part in range(2):
        write_landing(landing_frame(spark, *[row(f"{part}-{i}") for i in range(25)]), path, max_records=10)
    assert files.read_landing(spark, path).count() == 50
    sizes = files.read_landing(spark, path).groupBy("_metadata.file_name").count()
    assert sizes.count() == 6 and sizes.where("count > 10").count() == 0
    with pytest.raises(ValueError):
        write_landing(landing_frame(spark, row("x")), path, mode="overwrite")


def below(path):
    return [f"{folder}/{name}" for folder, _, names in os.walk(path) if "month=" in folder for name in names]


def test_small_files_have_no_sidecars_and_damage_in_them_raises(spark, tmp_path):
    path, large, own = (str(tmp_path / n) for n in ("landing", "large", "own"))
    rows = landing_frame(spark, *[row(f"some-key-{i:02d}") for i in range(25)])
    write_landing(rows, path, max_records=10)
    names = below(path)
    assert len(names) == 3 and all(n.endswith(".parquet") for n in names)
    write_landing(rows, large)
    assert sorted(n.endswith(".crc") for n in below(large)) == [False, True]
    spark.conf.set("fs.file.impl", "org.apache.hadoop.fs.LocalFileSystem")  # the session's own choice stays
    try:
        write_landing(rows, own, max_records=10)
    finally:
        spark.conf.unset("fs.file.impl")
    assert len(below(own)) == 6
    assert files.read_landing(spark, path).count() == files.read_landing(spark, own).count() == 25

    with open(names[0], "rb") as source:
        data = source.read()
    at = data.index(b"some-key-")
    with open(names[0], "wb") as out:
        out.write(data[:at] + b"S" + data[at + 1 :])
    with pytest.raises(Exception, match="(?i)checksum"):
        files.read_landing(spark, path).collect()


def test_existing_keys_read_one_column_of_the_months(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing_frame(spark, row("a", "01"), row("b", "12")), path)
    plan = plan_of(files.read_existing_keys(spark, path, ["2025-12"]))
    assert f"ReadSchema: struct<{KEY}:string>" in plan and "month=01" not in plan


def test_consolidated_files_can_be_left_out(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing_frame(spark, row("a")), path)
    folder = files.month_folder(path, "2025-12")
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    Folder(spark, path).move(f"{folder}/{name}", f"{folder}/consolidated-2025-12.parquet")
    write_landing(landing_frame(spark, row("b")), path)
    assert values(files.read_month_landing(spark, path, ["2025-12"]), KEY) == [("b",)]
    assert files.read_month_landing(spark, path, ["2025-12"], exclude=[]).count() == 2


def test_schema_drift_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing_frame(spark, row("old")).drop("ingestion_date", "source_file"), path)
    write_landing(landing_frame(spark, row("new")), path)
    assert values(files.read_landing(spark, path), KEY, "ingestion_date", "source_file") == [
        ("new", "2025-12-01", "f"), ("old", None, None),
    ]
    assert files.landed_schema(spark, path, ["2025-12"]).fieldNames()[-2:] == ["year", "month"]


def test_empty_month_gives_the_schema(spark, tmp_path):
    assert files.read_landing(spark, str(tmp_path / "none"), ["2025-12"]).schema == LANDING


def test_time_prefix_of_listing_is_stable(spark, source):
    before = values(files.list_files(spark, source, recursive=True))
    time.sleep(0.01)
    assert values(files.list_files(spark, source, recursive=True)) == before
