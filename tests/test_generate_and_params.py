"""Generator invariants (F2) and parameter validation."""

import math

import pytest
from pyspark.sql import functions as F

from fairsketch.functions.hashing import HashFamily, SketchSpec
from fairsketch.operators import heavy
from fairsketch.sources import generate
from fairsketch.sources.points import read_points, write_points
from fairsketch.session import scratch_path


@pytest.mark.parametrize("n,k", [(1000, 8), (1003, 5), (77, 3)])
def test_generator_invariants(spark, n, k):
    pts = generate.fair_gap_points(spark, n, k, seed=5)
    assert pts.count() == n
    q = n // k
    checks = generate.check_counts(pts, k, 5).collect()
    sizes = {}
    for r in checks:
        sizes[r["cid"]] = sizes.get(r["cid"], 0) + r["n"]
        assert r["in_disc"] and r["in_cluster"]
        if r["grp"] == "A":
            assert 1 <= r["n"] <= math.floor(0.4 * q)
    assert sorted(sizes) == list(range(k))
    assert all(s in (q, q + 1) for s in sizes.values())
    assert sum(1 for s in sizes.values() if s == q + 1) == n % k


def test_generator_quadrants(spark):
    spec = generate.spec(6, seed=1)
    signs = [(math.copysign(1, s["cx"]), math.copysign(1, s["cy"])) for s in spec]
    assert signs == [(1, 1), (1, 1), (-1, 1), (-1, 1), (-1, -1), (1, -1)]


def test_generator_rejects_small_n(spark):
    with pytest.raises(ValueError):
        generate.fair_gap_points(spark, 20, 5)


def test_points_roundtrip(spark):
    pts = generate.fair_gap_points(spark, 200, 4, seed=2)
    path = scratch_path(spark, "test-points")
    write_points(pts, path, 2)
    back = read_points(spark, path)
    assert back.count() == 200
    fixed = read_points(spark, path, dims=2)
    assert sorted(map(tuple, back.select("grp").collect())) == sorted(map(tuple, fixed.select("grp").collect()))


def test_hash_family_validation():
    with pytest.raises(ValueError):
        HashFamily((0,), (1,))
    with pytest.raises(ValueError):
        HashFamily((1,), (8191,))
    with pytest.raises(ValueError):
        HashFamily.draw(8191)
    with pytest.raises(ValueError):
        HashFamily((1,), (1,), p=2 ** 40)
    fam = HashFamily.draw(5)
    assert len(set(fam.a)) == 5 and all(1 <= a < 8191 for a in fam.a)
    with pytest.raises(ValueError):
        SketchSpec.draw(d=3, w=0)


def test_top_k_requires_positive_k(spark):
    hist = spark.createDataFrame([(1, 2)], "item bigint, freq bigint")
    with pytest.raises(ValueError):
        heavy.top_k_with_ties(hist, 0)


def test_item_parsing_strict_and_lenient(spark):
    from fairsketch.sources.items import items

    df = spark.createDataFrame([("12",), (" 7",), ("x1",)], "s string")
    assert sorted(r["item"] for r in items(df, F.trim("s"), strict=False).collect()) == [7, 12]
    with pytest.raises(Exception):
        items(df, F.trim("s")).collect()


def test_read_points_rejects_malformed_coordinates(spark):
    path = scratch_path(spark, "test-bad-points")
    spark.createDataFrame([("1.0,2.0,A",), ("oops,3.0,B",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_points(spark, path, dims=2).collect()
    with pytest.raises(Exception):
        read_points(spark, path).collect()
    ok = scratch_path(spark, "test-good-points")
    spark.createDataFrame([("1.0,2.0,A",), ("3.5,-1.0, B",), ("0,0,C",)], "value string").coalesce(1).write.text(ok)
    with pytest.raises(Exception):
        read_points(spark, ok).collect()  # other labels fail unless dropping them is asked for
    rows = sorted((tuple(r["p"]), r["grp"]) for r in read_points(spark, ok, other_labels="drop").collect())
    assert rows == [((1.0, 2.0), "A"), ((3.5, -1.0), "B")]  # labels trimmed
    assert read_points(spark, ok, other_labels="keep").count() == 3


def test_fair_centres_lower_phi_on_generated_points(spark):
    """The generator's purpose: on its mixtures, fair k-means beats standard k-means on Φ."""
    from fairsketch.operators import fair

    pts = generate.fair_gap_points(spark, 2000, 4, seed=5)
    rows = {r["method"]: r for r in fair.compare(pts, 4, 5, seed=1).collect()}
    assert set(rows) == {"standard", "fair"}
    assert rows["fair"]["phi"] < rows["standard"]["phi"]
