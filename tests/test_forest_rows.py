"""Rows keep their node of every tree while the forest grows; the forest is the one that is grown without."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier

from fieldlens.operators import crops


def test_forest_with_kept_nodes_is_the_same(spark, monkeypatch):
    rows = [(i, *[((i * k) % 97) / 97.0 for k in (3, 5, 7, 11, 13, 17, 19)], "a" if (i * 3) % 97 > 40 else "b") for i in range(300)]
    frame = spark.createDataFrame(rows, ["sample_id", *crops.FEATURES, "crop_type"]).coalesce(2)
    kept = crops.train(frame, trees=5, depth=6).stages[2]
    assert kept.getOrDefault("cacheNodeIds")

    monkeypatch.setattr(crops, "RandomForestClassifier", lambda **o: RandomForestClassifier(**{**o, "cacheNodeIds": False}))
    plain = crops.train(frame, trees=5, depth=6).stages[2]
    assert not plain.getOrDefault("cacheNodeIds")
    assert [t.toDebugString.split("\n")[1:] for t in kept.trees] == [t.toDebugString.split("\n")[1:] for t in plain.trees]
