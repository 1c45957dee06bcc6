"""Views of landed months: readers, crashes, other writers, and the collection of old files."""

import pytest
from pyspark.sql import functions as F

from helpers import values
from odmeter.schemas import KEY, LANDING
from odmeter.sinks import swap, views
from odmeter.sinks.landing import write_landing
from odmeter.sources import files

DEC = ["2025-12"]


def row(key, month="12", distance=1.0, day="2025-12-01"):
    return (key, distance, 2.0, day, "2025-12-01T00:00:00.000000", "f.parquet", "2025", month)


def landing_frame(spark, *rows):
    return spark.createDataFrame(list(rows), LANDING)


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing_frame(spark, row("a"), row("b"), row("n", "11")), path)
    write_landing(landing_frame(spark, row("c")), path)
    return path


def seen(spark, landing, months=DEC):
    return values(files.read_landing(spark, landing, months), KEY, "distance")


OLD = [("a", 1.0), ("b", 1.0), ("c", 1.0)]
NEW = [("a", 9.0), ("b", 9.0), ("c", 9.0)]


def replace(spark, landing, folder=None, keep_old=False):
    before = swap.file_snapshot(spark, landing, DEC)
    rows = files.read_landing(spark, landing, DEC).withColumn("distance", F.lit(9.0))
    swap.replace_months(rows.repartition(2), landing, {"2025-12": 3}, before, keep_old=keep_old, folder=folder)


class Stops(swap.Folder):
    """Is cut off at its n-th move."""

    def __init__(self, spark, root, moves):
        super().__init__(spark, root)
        self.left = moves

    def move(self, source, target):
        if self.left == 0:
            raise KeyboardInterrupt
        self.left -= 1
        super().move(source, target)


@pytest.mark.parametrize("moves", range(5))
def test_cut_off_at_any_move_shows_old_or_new_and_is_repaired(spark, landing, moves):
    """Moves: the view that hides what comes, the files that come, the view that shows them."""
    folder = Stops(spark, landing, moves)
    try:
        replace(spark, landing, folder, keep_old=True)
        cut = False
    except KeyboardInterrupt:
        cut = True
    want = OLD if cut else NEW
    assert seen(spark, landing) == want and seen(spark, landing, None) == sorted(want + [("n", 1.0)])
    assert swap.file_snapshot(spark, landing, DEC)["2025-12"].files in (1, 2)
    swap.repair(spark, landing)
    assert seen(spark, landing) == want
    views.collect_retired(spark, landing)
    assert seen(spark, landing) == want
    assert len(swap.Folder(spark, landing).sizes(files.month_folder(landing, "2025-12"))) == 2
    replace(spark, landing)
    assert seen(spark, landing) == NEW


def test_reader_from_before_the_switch_still_reads(spark, landing):
    early = files.read_landing(spark, landing, DEC)
    replace(spark, landing, keep_old=True)
    assert values(early, KEY, "distance") == OLD and seen(spark, landing) == NEW
    assert views.collect_retired(spark, landing) == DEC and views.collect_retired(spark, landing) == []
    assert seen(spark, landing) == NEW


def test_files_that_arrive_meanwhile_are_seen(spark, landing):
    class Late(swap.Folder):
        arrived = False

        def move(self, source, target):
            if not self.arrived:
                self.arrived = True
                write_landing(landing_frame(spark, row("late")), landing)
            super().move(source, target)

    replace(spark, landing, Late(spark, landing))
    assert seen(spark, landing) == sorted(NEW + [("late", 1.0)])


def test_view_that_changes_while_files_are_listed_is_looked_at_again(spark, landing, monkeypatch):
    real, looks = files.current_views, []

    def slow(*args):
        found = real(*args)
        looks.append(found)
        if len(looks) == 1:  # the switch comes between the first look and the listing
            monkeypatch.setattr(files, "current_views", real)
            replace(spark, landing, keep_old=True)
            monkeypatch.setattr(files, "current_views", slow)
        return found

    monkeypatch.setattr(files, "current_views", slow)
    assert seen(spark, landing) == NEW and len(looks) == 3


def test_two_writers_of_one_month(spark, landing):
    folder = swap.Folder(spark, landing)
    place = views.month_place(views.views_root(landing), "2025-12")
    views.put_view(folder, place, views.View(1, views.BRING, {}, {}))
    with pytest.raises(views.ViewTaken):
        views.put_view(folder, place, views.View(1, views.BRING, {}, {"x": 1}))
    with pytest.raises(views.ViewTaken):
        replace(spark, landing)
    assert seen(spark, landing) == OLD
    assert swap.repair(spark, landing) == DEC
    replace(spark, landing)
    assert seen(spark, landing) == NEW
