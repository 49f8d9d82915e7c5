"""Point lines sorted out instead of failing."""

import pytest

from fairsketch.sources.points import REASONS, read_points, read_points_checked, write_sorted_out
from fairsketch.session import scratch_path
from fairsketch.sources.items import ITEM_REASONS, read_item_lines, read_items_checked

GOOD = ["1.5,2,A", " 3 , -4e2 ,B ", "0,0,A"]
BAD = {"": 0, "   ": 0, "1,A": 1, "1,2,3,B": 1, "x,2,A": 2, ",2,A": 2, "1,NaN,B": 2, "1,2,C": 3, "1,2,": 3, "A": 1}


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("spoilt") / "points.txt"
    path.write_text("\n".join([*GOOD, *BAD]) + "\n")
    return f"file:{path}"


def test_good_and_bad_lines_come_from_one_scan(spark, lines):
    df = read_points_checked(spark, lines, dims=2)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = df.collect()
    assert sorted((tuple(r["p"]), r["grp"]) for r in rows if r["reason"] is None) == [((0.0, 0.0), "A"), ((1.5, 2.0), "A"), ((3.0, -400.0), "B")]
    assert all(r["line"] is None for r in rows if r["reason"] is None)
    assert {r["line"]: r["reason"] for r in rows if r["reason"]} == {line: REASONS[k] for line, k in BAD.items()}
    assert all(r["p"] is None and r["grp"] is None for r in rows if r["reason"])


def test_any_dimension(spark, lines):
    reasons = {r["line"]: r["reason"] for r in read_points_checked(spark, lines).collect() if r["reason"]}
    assert "1,A" not in reasons and "1,2,3,B" not in reasons and reasons["A"] == REASONS[1]


def test_sorted_out_folders(spark, lines):
    good, bad = write_sorted_out(read_points_checked(spark, lines, dims=2), scratch_path(spark, "test-sorted-out"))
    assert spark.read.parquet(good).count() == len(GOOD) and spark.read.parquet(bad).count() == len(BAD)


def test_the_strict_reader_fails_on_each_bad_line(spark, tmp_path):
    for k, line in enumerate(BAD):
        (tmp_path / f"{k}.txt").write_text(line + "\n")
        if line.strip() and BAD[line] != 1:
            with pytest.raises(Exception):
                read_points(spark, f"file:{tmp_path}/{k}.txt").collect()


def test_item_lines_sorted_out(spark, tmp_path):
    good = {"7": 7, " -3 ": -3, "+5": 5, "9223372036854775807": 2 ** 63 - 1}
    bad = {"": 0, "  ": 0, "x": 1, "1.5": 1, "1 2": 1, "9223372036854775808": 2}
    (tmp_path / "items.txt").write_text("\n".join([*good, *bad]) + "\n")
    df = read_items_checked(spark, f"file:{tmp_path}/items.txt")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = df.collect()
    assert sorted(r["item"] for r in rows if r["reason"] is None) == sorted(good.values())
    assert all(r["line"] is None for r in rows if r["reason"] is None)
    assert {r["line"]: r["reason"] for r in rows if r["reason"]} == {line: ITEM_REASONS[k] for line, k in bad.items()}
    assert all(r["item"] is None for r in rows if r["reason"])
    strict = [r["item"] for r in read_item_lines(spark, f"file:{tmp_path}/items.txt", strict=False).collect()]
    assert sorted(strict) == sorted(good.values())
