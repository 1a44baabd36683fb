"""Scenes, labels, splits, the classifier and detection edits."""

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import spectral
from fieldlens.operators import crops, sampling, scenes
from fieldlens.plans import catalog
from fieldlens.sources import layers

SF = "/root/testdata/sf0.001"


def test_rule_order(spark):
    rows = [
        (1, 0.80, 0.50, 0.0, 0.0, 0.0, "Kukuruz"), (2, 0.77, 0.40, 0.0, 0.0, 0.05, "Soja"), (3, 0.72, 0.40, 0.0, 0.0, 0.12, "Pšenica"),
        (4, 0.60, 0.0, 0.05, 0.30, 0.0, "Suncokret"), (5, 0.60, 0.0, 0.09, 0.20, 0.0, "Ječam"), (6, 0.73, 0.40, 0.0, 0.0, 0.16, "Pšenica"),
    ]
    frame = spark.createDataFrame(rows, "id long, ndvi double, nir double, red double, swir double, ndwi double, want string")
    label = spectral.rule_label(*[F.col(c) for c in ("ndvi", "nir", "red", "swir", "ndwi")], F.col("id"))
    assert frame.where(label != F.col("want")).count() == 0


def test_null_safe_clamp_and_indices(spark):
    row = spark.sql("select cast(null as double) n, 0.0D a, 3.0D b").select(
        spectral.clamp(F.col("n"), 0.0, 1.0).alias("n"), spectral.ndvi(F.col("a"), F.col("a")).alias("z"), spectral.clamp(F.col("b"), 0.0, 1.0).alias("b")
    ).first()
    assert row.n is None and row.z is None and row.b == 1.0


def test_empty_scene_set_stays_empty(spark):
    found = scenes.filter_scenes(spark.sql("select 1 scene_id, 90.0D cloud"), None, None)
    pixels = spark.sql("select 1 scene_id, 1 pixel_id, 0.1D blue, 0.1D green, 0.1D red, 0.5D nir, 0.2D swir")
    out = scenes.median_composite(scenes.pixels_of(pixels, found))
    assert out.count() == 0 and {"ndvi", "ndwi", "savi"} <= set(out.columns)


def test_ranks_equal_row_number_with_one_hot_group(spark):
    frame = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("g"))
    ours = sampling.ranked(frame.repartition(13), "g", spectral.mix(F.col("id"), 42), spectral.MIX_SPAN, "id")
    frame.withColumn("o", spectral.mix(F.col("id"), 42)).createOrReplaceTempView("ranks")
    plain = spark.sql("select id, row_number() over (partition by g order by o, id) r from ranks")
    assert ours.join(plain, "id").where("rank <> r").count() == 0 and ours.count() == 4000


def test_model_round_trip_and_refusal(spark, tmp_path):
    frame = catalog._training(spark, SF)
    train, test = crops.split(frame)
    assert train.count() + test.count() == frame.count()
    model = crops.load_or_train(spark, str(tmp_path / "m"), train, trees=5, depth=4)
    again = crops.load_or_train(spark, str(tmp_path / "m"), train)
    a = crops.score(model, test).orderBy("sample_id").select("predicted", "probability").collect()
    b = crops.score(again, test).orderBy("sample_id").select("predicted", "probability").collect()
    assert a == b and len(a) == test.count()
    with pytest.raises(ValueError):
        crops.train(train.limit(10))


def test_detections_upsert_and_edit(spark, tmp_path):
    scored = spark.sql("select 1L sample_id, 19.5D longitude, 45.0D latitude, 0.71234D ndvi, 20.0D temperature, 60.0D humidity, 0.5D probability, 'Soja' predicted")
    one = crops.detections(scored)
    first = crops.save_detections(spark, one.unionByName(one), str(tmp_path), "v1")
    assert first.count() == one.count()
    both = crops.detections(scored.unionByName(scored.withColumn("sample_id", F.lit(2).cast("long"))).withColumn("predicted", F.lit("Kukuruz")))
    saved = crops.save_detections(spark, both, str(tmp_path), "v2", "v1")
    assert sorted((r.detection_id, r.crop_type) for r in saved.collect()) == [(1, "Kukuruz"), (2, "Kukuruz")]
    edits = spark.createDataFrame(
        [(1, "confidence", "12.5", 1), (1, "confidence", "77", 2), (1, "crop_type", "Soja", 3), (2, "area_ha", "much", 1), (9, "color", "#1", 1), (1, "nope", "x", 1)],
        "detection_id long, attribute string, value string, seq int",
    )
    edited, rejected, tally = crops.edit_attributes(saved, edits)
    row = edited.where("detection_id = 1").first()
    assert (float(row.confidence), row.crop_type) == (77.0, "Soja")
    assert sorted(r.reason for r in rejected.collect()) == ["not a number", "unknown attribute", "unknown detection"]
    assert tuple(tally.first()) == (3, 3)


def test_present(spark):
    out = layers.present(spark.sql("select timestamp'2025-01-02 03:04:05' t, cast(null as int) n, 1.5D d, 1 x0"))
    assert tuple(out.first()) == ("2025-01-02 03:04:05", "", "1.5") and out.columns == ["t", "n", "d"]


def test_filters_reach_the_scan(spark):
    from fieldlens.sources.layers import region_filter
    from fieldlens.sources.schemas import BOX

    frame = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("l_orderkey id", "l_quantity x0", "l_quantity y0", "l_tax x1", "l_tax y1", "l_comment" if False else "l_returnflag")
    text = region_filter(frame.select("id", *BOX))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(" in text and "l_returnflag" not in text.split("ReadSchema")[1]
