"""Replace files of landed months: stage, verify, swap, and repair after a crash.

A path is never overwritten while it is read.  The new rows go to a staging table beside the landing
table; only when the row counts are as expected, and the month still holds exactly the files that were
read, does the swap begin.  It works file by file, because on an object store a move of a directory is a
copy of its files:

1. an *intent* names the files that go and the files that come, each with its size;
2. exactly the files that were read move to the backup folder; files that arrived meanwhile stay where they are;
3. the staged files move in, a *done* mark is written, and only then the backup is deleted.

``repair`` reads the intent.  Without a done mark it goes forward if every new file is complete, by name
and size, in the month or in staging; else it goes back.  A copy is deleted only where the other is complete.
Between steps 2 and 3 a reader of ``swap_months`` sees the month without the old rows or with a part of the new ones.

``replace_months``, which maintenance uses, switches a view instead (``sinks.views``): its readers never see a part.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odmeter.schemas import MONTH
from odmeter.sinks.views import collect_retired, current_views, repair_views, switch_months
from odmeter.sources.files import list_landing, month_folder, read_landing
from odmeter.sources.paths import Folder, existing

INTENT, DONE = "_intent", "_done"


class ReplaceRefused(RuntimeError):
    """The month was left as it is."""


def staging_root(landing: str) -> str:
    return f"{landing.rstrip('/')}__staging"


def _backup_root(landing: str) -> str:
    return f"{landing.rstrip('/')}__replaced"


@dataclass(frozen=True)
class MonthFiles:
    """Files of a landed month: how many, how large, and a fingerprint of names, sizes and times."""

    files: int
    size: int
    fingerprint: int


def file_snapshot(spark: SparkSession, landing: str, months: list[str]) -> dict[str, MonthFiles]:
    """State of the landed files, one entry per month that has any; no file list reaches the driver."""
    if not existing(spark, [month_folder(landing, m) for m in months]):
        return {}
    facts = list_landing(spark, landing, months).groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("size"),
        F.bit_xor(F.xxhash64("file_name", "file_size", "file_time")).alias("fingerprint"),
    )
    return {r[MONTH]: MonthFiles(r["files"], r["size"], r["fingerprint"]) for r in facts.collect()}


def stage_months(rows: DataFrame, landing: str, max_records: int | None = None) -> str:
    """Writes the replacement rows to the staging table, one directory per month."""
    target = staging_root(landing)
    Folder(rows.sparkSession, target).delete(target)
    writer = rows.write.partitionBy("year", "month").mode("errorifexists")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(target)
    return target


def swap_months(
    spark: SparkSession,
    landing: str,
    expected_rows: dict[str, int],
    read_files: dict[str, MonthFiles],
    retire: dict[str, list[str]] | None = None,
    folder: Folder | None = None,
) -> None:
    """Moves staged files in and the files that were read out, month by month, after checking all of them.

    expected_rows   rows that each staged month must have
    read_files      ``file_snapshot`` taken before the rows were read
    retire          names of the files that go, by month; all that were read by default

    File names of one month at a time are on the driver.
    """
    folder = folder or Folder(spark, landing)
    going_of = files_to_retire(spark, landing, expected_rows, read_files, retire, folder)
    for month, going in going_of.items():
        live, backup, new = (month_folder(root, month) for root in (landing, _backup_root(landing), staging_root(landing)))
        coming = folder.sizes(new)
        folder.write(f"{backup}/{INTENT}", json.dumps({"old": going, "new": coming}))
        for name in going:
            folder.move(f"{live}/{name}", f"{backup}/{name}")
        for name in coming:
            folder.move(f"{new}/{name}", f"{live}/{name}")
        folder.write(f"{backup}/{DONE}", "")
        folder.delete(backup)
    folder.delete(staging_root(landing))


def files_to_retire(
    spark: SparkSession,
    landing: str,
    expected_rows: dict[str, int],
    read_files: dict[str, MonthFiles],
    retire: dict[str, list[str]] | None,
    folder: Folder,
) -> dict[str, dict[str, int]]:
    """Names and sizes of the files that go, by month; ``ReplaceRefused`` if staged rows or read files are not as expected."""
    months = sorted(expected_rows)
    # Listed before the check: what arrives after the list makes the check fail, or stays.
    old = {m: folder.sizes(month_folder(landing, m)) for m in months}
    staged = read_landing(spark, staging_root(landing), months).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
    counted = {f"{r['year']}-{r['month']}": r["n"] for r in staged.collect()}
    wrong = {m: (expected_rows[m], counted.get(m, 0)) for m in months if expected_rows[m] != counted.get(m, 0)}
    if wrong:
        raise ReplaceRefused(f"staged rows differ from expected (expected, staged): {wrong}")
    now = file_snapshot(spark, landing, months)
    changed = [m for m in months if now.get(m) != read_files[m]]
    if changed:
        raise ReplaceRefused(f"files came or went since the months were read: {changed}")

    hidden = {m: v.hidden for m, v in current_views(spark, landing, months).items()}
    seen = {m: {n: size for n, size in old[m].items() if n not in hidden.get(m, ())} for m in months}
    return seen if retire is None else {m: {n: old[m][n] for n in retire[m]} for m in months}


def replace_months(
    rows: DataFrame,
    landing: str,
    expected_rows: dict[str, int],
    read_files: dict[str, MonthFiles],
    max_records: int | None = None,
    retire: dict[str, list[str]] | None = None,
    keep_old: bool = False,
    folder: Folder | None = None,
) -> None:
    """Replaces the months of ``rows``, or the files ``retire`` of them: stage, verify, switch the view.

    Readers see a month's old rows or its new ones.  ``keep_old`` leaves the old files, hidden, for ``views.collect_retired``: give it where
    readers may be under way.
    """
    spark = rows.sparkSession
    stage_months(rows, landing, max_records)
    folder = folder or Folder(spark, landing)
    going = files_to_retire(spark, landing, expected_rows, read_files, retire, folder)
    switch_months(spark, landing, staging_root(landing), going, folder)
    if not keep_old:
        collect_retired(spark, landing, sorted(going))


def repair(spark: SparkSession, landing: str) -> list[str]:
    """Finishes or undoes swaps that were cut off; returns the months that were touched.

    Raises ``ReplaceRefused``, and deletes nothing, where neither the old nor the new files are complete.
    """
    folder = Folder(spark, landing)
    backups = _backup_root(landing)
    touched = repair_views(spark, landing)
    for year in folder.names(backups):
        for month in folder.names(f"{backups}/{year}"):
            place = f"{year}/{month}"
            _repair_month(folder, *(f"{root}/{place}" for root in (landing, backups, staging_root(landing))))
            touched.append(place.replace("year=", "").replace("/month=", "-"))
    folder.delete(backups)
    folder.delete(staging_root(landing))
    return touched


def _repair_month(folder: Folder, live: str, backup: str, staged: str) -> None:
    if folder.exists(f"{backup}/{DONE}"):
        folder.delete(backup)
        return
    places = {where: folder.sizes(where) for where in (live, backup, staged)}
    try:
        intent = json.loads(folder.read(f"{backup}/{INTENT}")) if folder.exists(f"{backup}/{INTENT}") else None
    except ValueError:  # cut off while it was written: no file has moved yet
        intent = {"old": {}, "new": {}}
    if intent is None:  # a backup of unknown origin: its files go back where the month lacks them
        intent = {"old": places[backup], "new": {}}

    def whole(where: str, name: str, size: int) -> bool:
        return places[where].get(name) == size

    def bring(name: str, size: int, source: str, target: str) -> None:
        """The complete copy of a file at ``target`` only; a partial one there is replaced."""
        if whole(target, name, size):
            folder.delete(f"{source}/{name}")
        else:
            folder.delete(f"{target}/{name}")
            folder.move(f"{source}/{name}", f"{target}/{name}")

    old, new = intent["old"], intent["new"]
    forward = bool(new) and all(whole(live, n, s) or whole(staged, n, s) for n, s in new.items())
    if not forward and not all(whole(live, n, s) or whole(backup, n, s) for n, s in old.items()):
        raise ReplaceRefused(f"neither the old nor the new files of {live} are complete")
    if forward:
        for name, size in new.items():
            bring(name, size, staged, live)
        folder.write(f"{backup}/{DONE}", "")
        for name in old:
            folder.delete(f"{live}/{name}")
    else:
        for name, size in old.items():
            bring(name, size, backup, live)
        for name in new:
            folder.delete(f"{live}/{name}")
    folder.delete(backup)
