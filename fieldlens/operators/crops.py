"""The crop classifier: training frame, model, scores, detections and their report."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import shapes, spectral
from fieldlens.operators import changes, grid, nearest, scenes
from fieldlens.operators.sampling import stratified_split
from fieldlens.operators.spread import checkpointed
from fieldlens.sources.schemas import DETECTION

FEATURES = ("ndvi", "temperature", "humidity", "red_band", "nir_band", "ndwi", "savi")
MIN_ROWS = 50
METHOD = "RandomForest + Sentinel-2"
# Clip limits of the features.
LIMITS = {
    "ndvi": (0.0, 1.0),
    "temperature": (5.0, 35.0),
    "humidity": (20.0, 95.0),
    "red_band": (0.01, 0.3),
    "nir_band": (0.2, 0.7),
    "savi": (0.0, 1.0),
}


def clipped(frame: DataFrame) -> DataFrame:
    """Features inside their limits: the same for training and scoring."""
    return frame.withColumns({c: spectral.clamp(F.col(c), *LIMITS[c]) for c in LIMITS if c in frame.columns})


def feature_frame(samples: DataFrame, weather: DataFrame, scale: float = 1.0) -> DataFrame:
    """Features of sampled pixels with weather, missing values replaced by their defaults.

    ``samples`` holds sample_id, x, y, the bands and the indices of the composite. Rows
    without red, near infrared or NDVI are dropped. ``scale`` divides the reflectances.
    """
    keyed = samples.withColumns({b: F.col(b) / F.lit(scale) for b in scenes.BANDS if b in samples.columns})
    complete = scenes.complete_cases(keyed, ["red", "nir", "ndvi"])
    placed = scenes.attach_weather(complete, weather)
    return placed.withColumnsRenamed({b: f"{b}_band" for b in scenes.BANDS if b in placed.columns}).withColumns(
        {
            "temperature": F.coalesce("temperature", F.lit(20.0)),
            "humidity": F.coalesce("humidity", F.lit(60.0)),
            "ndwi": F.coalesce("ndwi", F.lit(0.15)),
            "savi": F.coalesce("savi", F.col("ndvi") * 0.8 + 0.1),
        }
    )


def training_frame(samples: DataFrame, weather: DataFrame, scale: float = 1.0, seed: int = 42) -> DataFrame:
    """Labelled features of the complete pixels: rules first, then the clip."""
    full = feature_frame(scenes.complete_cases(samples), weather, scale)
    label = spectral.rule_label(
        F.col("ndvi"), F.col("nir_band"), F.col("red_band"), F.col("swir_band"), F.col("ndwi"), F.col("sample_id"), seed
    )
    return clipped(full.withColumn("crop_type", label)).select("sample_id", *FEATURES, "crop_type")


def train(
    frame: DataFrame, label: str = "crop_type", features: tuple[str, ...] = FEATURES, trees: int = 150, depth: int = 12, seed: int = 42,
    min_rows: int = MIN_ROWS,
) -> PipelineModel:
    """Fit encoder, scaler and forest; refuses fewer than ``min_rows`` rows.

    The frame is read once for each stage, so it is kept while fitting.
    """
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(frame, label, features, trees, depth, seed, min_rows)
    finally:
        frame.unpersist()


def _fit(frame: DataFrame, label: str, features: tuple[str, ...], trees: int, depth: int, seed: int, min_rows: int) -> PipelineModel:
    if len(frame.limit(min_rows).select(label).collect()) < min_rows:
        raise ValueError(f"at least {min_rows} training rows are needed")
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(frame)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        # rows keep their node of every tree, instead of walking down from the root for each level
        RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed, cacheNodeIds=True),
    ]
    fitted = Pipeline(stages=stages).fit(index.transform(frame))
    decode = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)
    return PipelineModel([*fitted.stages, decode])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_train(spark: SparkSession, path: str, frame: DataFrame, **options) -> PipelineModel:
    """The saved model, or a new one trained on the frame and saved."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return PipelineModel.load(path)
    model = train(frame, **options)
    save_model(model, path)
    return model


def split(frame: DataFrame, label: str = "crop_type", key: str = "sample_id", test_share: float = 0.2, seed: int = 42):
    marked = stratified_split(frame, label, key, test_share, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def score(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Class and highest class probability of every row."""
    out = model.transform(frame)
    return out.select(
        *frame.columns, "predicted", F.array_max(vector_to_array("probability")).alias("probability")
    )


def class_metrics(predictions: DataFrame, label: str = "crop_type", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    counts = predictions.groupBy(F.col(label).alias("truth"), F.col(predicted).alias("guess")).count()
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("class"), F.col("count").alias("support"), F.lit(0).cast("long").alias("guessed")),
                F.struct(F.col("guess").alias("class"), F.lit(0).cast("long").alias("support"), F.col("count").alias("guessed")),
            )
        ).alias("s"),
        F.when(F.col("truth") == F.col("guess"), F.col("count")).otherwise(0).alias("hit"),
    )
    g = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed"), (F.sum("hit") / 2).alias("hits")
    )
    p = F.coalesce(F.try_divide("hits", "guessed"), F.lit(0.0))
    r = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    return g.select("class", p.alias("precision"), r.alias("recall"), "support").select(
        "class",
        "precision",
        "recall",
        F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)).alias("f1"),
        "support",
    )


def accuracy(predictions: DataFrame, label: str = "crop_type", predicted: str = "predicted") -> DataFrame:
    return predictions.agg((F.count_if(F.col(label) == F.col(predicted)) / F.count("*")).alias("accuracy"))


def importances(spark: SparkSession, model: PipelineModel, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Feature importances, highest first. One value per feature, held by the model."""
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    values = [float(v) for v in forest.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def footprint(lon: Column, lat: Column, dx: float, dy: float) -> Column:
    """A box of the given size centred on a point."""
    return shapes.box_shape(lon - dx / 2, lat - dy / 2, lon + dx / 2, lat + dy / 2)


def box_hectares(lat: Column, dx: float, dy: float) -> Column:
    return F.lit(dx * dy * 111000.0 * 111000.0 * 0.0001) * F.cos(F.radians(lat))


def detections(scored: DataFrame, dx: float = 0.005, dy: float = 0.005, method: str = METHOD) -> DataFrame:
    """Detection records of scored pixels (sample_id, longitude, latitude, features, scores)."""
    made = scored.select(
        F.col("sample_id").cast("long").alias("detection_id"),
        F.col("predicted").alias("crop_type"),
        F.bround(F.col("probability") * 100, 1).alias("confidence"),
        F.bround("ndvi", 4).alias("ndvi_mean"),
        F.lit(None).cast("double").alias("lai_estimate"),
        F.bround(box_hectares(F.col("latitude"), dx, dy), 2).alias("area_ha"),
        "latitude",
        "longitude",
        F.bround("temperature", 1).alias("temperature"),
        F.bround("humidity", 1).alias("humidity"),
        F.lit(method).alias("detection_method"),
        spectral.class_colour(F.col("predicted")).alias("color"),
        footprint(F.col("longitude"), F.col("latitude"), dx, dy).alias("shape"),
        F.current_timestamp().alias("created_at"),
    )
    return made.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in DETECTION.fields])


def save_detections(spark: SparkSession, new: DataFrame, directory: str, version: str, previous: str | None = None) -> DataFrame:
    """Upsert detections into a new table version and read it back."""
    from fieldlens.sources.tables import read_table, write_table

    known = {DETECTION.name: DETECTION}
    batch = new.withColumns({"action": F.lit("insert"), "seq": F.lit(1)})
    if previous is None:  # a repeated id counts once from the first version on
        rows = changes.latest(batch, DETECTION.key, "seq").select(*new.columns)
    else:
        old = read_table(spark, f"{directory}/{previous}", DETECTION.name, known)
        rows = changes.upsert(old, batch, DETECTION)
    write_table(rows, f"{directory}/{version}", DETECTION.name)
    return read_table(spark, f"{directory}/{version}", DETECTION.name, known)


def class_counts(frame: DataFrame, column: str = "crop_type") -> DataFrame:
    return frame.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def class_stats(frame: DataFrame) -> DataFrame:
    """Per class: rows, mean and total area, mean NDVI and confidence; rounded after aggregation."""
    exact = lambda c: F.col(c).cast("decimal(18,4)")
    return (
        frame.where(F.col("crop_type").isNotNull())
        .groupBy("crop_type")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum(exact("area_ha")).cast("double") / F.count("area_ha"), 2).alias("mean_area_ha"),
            F.round(F.sum(exact("ndvi_mean")).cast("double") / F.count("ndvi_mean"), 2).alias("mean_ndvi"),
            F.round(F.sum(exact("confidence")).cast("double") / F.count("confidence"), 2).alias("mean_confidence"),
            F.round(F.sum(exact("area_ha")).cast("double"), 2).alias("total_area_ha"),
        )
        .orderBy("crop_type")
    )


def edit_attributes(frame: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply text edits (detection_id, attribute, value, seq).

    Returns the new detections, the rejected edits with a reason, and a one-row count of
    applied and ignored edits. Numbers that do not parse are rejected, never stored.
    """
    kinds = {f.name: f.type for f in DETECTION.fields if f.name not in ("detection_id", "shape", "created_at")}
    names = [n for n in kinds if n in frame.columns]
    known = F.col("attribute").isin(names)
    value = F.col("value")
    parses = F.lit(True)
    for n in names:
        if kinds[n].typeName() == "decimal":
            wrong = (F.col("attribute") == n) & value.isNotNull() & F.expr(f"try_cast(value as {kinds[n].simpleString()})").isNull()
            parses = parses & ~F.coalesce(wrong, F.lit(False))
    ids = frame.select(F.col("detection_id").alias("_id"))
    checked = edits.join(ids, F.col("detection_id") == F.col("_id"), "left").withColumn(
        "reason",
        F.when(F.col("_id").isNull(), "unknown detection").when(~known, "unknown attribute").when(~parses, "not a number"),
    )
    good = checked.where("reason is null").select("detection_id", "attribute", "value", "seq")
    # per attribute the last edit, as one row per detection: an aggregate over at most a dozen names
    last = good.groupBy("detection_id").agg(
        *[
            F.max(F.when(F.col("attribute") == n, F.struct("seq", "value"))).alias(f"_{n}")
            for n in names
        ]
    )
    base = frame.join(last.withColumnRenamed("detection_id", "_key"), F.col("detection_id") == F.col("_key"), "left")
    edited = base.select(
        *[
            (
                F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}")["value"].cast(frame.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                if c in names
                else F.col(c)
            )
            for c in frame.columns
        ]
    )
    rejected = checked.where("reason is not null").select("detection_id", "attribute", "value", "seq", "reason")
    tally = checked.agg(
        F.count_if(F.col("reason").isNull()).alias("applied"), F.count_if(F.col("reason").isNotNull()).alias("ignored")
    )
    return edited, rejected, tally


def detection_report(found: DataFrame, layers: dict[str, DataFrame], planar: DataFrame | None = None) -> dict[str, DataFrame]:
    """Statistics, landuse matches and road distances, as far as the layers are there.

    ``planar`` and the roads are in metres; without it distances are left out.
    """
    out = {"class_stats": class_stats(found)}
    if "landuse" in layers:
        boxed = shapes.with_bounds(found)
        # what two parts of the report read is worked out once
        matched = checkpointed(grid.matched_keys(boxed, layers["landuse"], "detection_id"))
        out["landuse_overlap"] = grid.spatial_join(boxed, layers["landuse"], "left", ("_ml", "_lu"), "detection_id", matched)
        out["landuse_matched"] = grid.count_matched(boxed, layers["landuse"], "detection_id", matched)
    if "roads" in layers and planar is not None:
        dist = checkpointed(nearest.nearest_distance(planar, layers["roads"], "road_distance_m", "detection_id"))
        out["road_distance"] = dist
        out["road_distance_stats"] = nearest.distance_stats(dist, "road_distance_m")
    return out
