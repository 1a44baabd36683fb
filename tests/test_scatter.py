"""Random points in polygons: all inside, an even share for every stretch, the same whatever the partitioning."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import overlay, scatter
from test_meeting import inside
from test_spatial import box, polygons, regular

RINGS = {
    1: [box(0, 0, 400, 300), [(100, 100), (100, 200), (200, 200), (200, 100)]],
    2: [regular(900, 500, 260, 7, 0.3)],
    3: [[(300, 200), (800, 250), (500, 700)]],  # runs over the first two
    4: [box(3000, 3000, 10, 10)],
}


@pytest.fixture(scope="module")
def layer(spark):
    return polygons(spark, RINGS)


def test_inside_and_even(spark, layer):
    n = 4000
    points = scatter.random_points(layer, n, size=256.0).collect()
    assert sorted(p.id for p in points) == list(range(n))
    assert all(any(inside((p.x, p.y), rings) for rings in RINGS.values()) for p in points)
    area = overlay.union_area(layer).first().area
    small = sum(p.x > 2000 for p in points)
    assert abs(small - n * 100 / area) <= 1
    # the free part of the first box, by quarters of its lower half
    quarters = Counter(int(p.x // 100) for p in points if p.x < 400 and p.y < 100)
    share = n * 100 * 100 / area
    assert all(abs(quarters[q] - share) < 5 * math.sqrt(share) for q in range(4))
    # a triangle-like stretch: x has the mean of the area and not of the box
    lone = scatter.random_points(polygons(spark, {1: [[(0, 0), (300, 0), (300, 300)]]}), 3000, size=1000.0)
    x, y = lone.agg(F.avg("x"), F.avg("y")).first()
    assert x == pytest.approx(200, abs=4) and y == pytest.approx(100, abs=5)


def test_same_points_whatever_the_partitioning(spark, layer):
    rows = lambda frame: sorted(tuple(r) for r in frame.collect())
    first = rows(scatter.random_points(layer, 300, size=256.0))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert rows(scatter.random_points(layer.repartition(4, "x0"), 300, size=256.0)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(scatter.random_points(layer, 300, seed=7, size=256.0)) != first


def test_empty_and_few(spark, layer):
    assert scatter.random_points(layer.where("false"), 10).count() == 0
    assert scatter.random_points(layer, 1).count() == 1
    spots = layer.select("id", shapes.point_shape(F.col("x0"), F.col("y0")).alias("shape"))
    assert scatter.random_points(shapes.with_bounds(spots), 10).count() == 0
