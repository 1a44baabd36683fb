"""Scene collections and pixel tables: filters, composites, indices and point sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import shapes, spectral

# Study window, season, cloud limit and cell sizes.
WINDOW = (19.05, 44.73, 20.35, 45.25)
SEASON = ("2025-04-01", "2025-09-30")
CLOUD_LIMIT = 20.0
PIXEL_M = 30.0
WEATHER_M = 11132.0
BANDS = ("blue", "green", "red", "nir", "swir")
SENSOR_BANDS = {"B2": "blue", "B3": "green", "B4": "red", "B8": "nir", "B11": "swir"}


def filter_scenes(
    scenes: DataFrame,
    window: tuple[float, float, float, float] | None = WINDOW,
    season: tuple[str, str] | None = SEASON,
    cloud_limit: float = CLOUD_LIMIT,
) -> DataFrame:
    """Scenes that meet the window, from the first day up to but not on the last, clear enough.

    Plain comparisons on columns, so they reach the Parquet scan. Nothing left is an empty frame.
    """
    out = scenes.where(F.col("cloud") < cloud_limit)
    if season is not None:
        first, last = season
        out = out.where((F.col("ts") >= F.lit(first).cast("timestamp_ntz")) & (F.col("ts") < F.lit(last).cast("timestamp_ntz")))
    if window is not None:
        box = tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
        out = out.where(shapes.boxes_meet(box, tuple(F.lit(v) for v in window)))
    return out


def pixels_of(pixels: DataFrame, scenes: DataFrame) -> DataFrame:
    """Pixels of the chosen scenes."""
    return pixels.join(scenes.select("scene_id").distinct(), "scene_id", "left_semi")


def rename_bands(pixels: DataFrame) -> DataFrame:
    return pixels.withColumnsRenamed({k: v for k, v in SENSOR_BANDS.items() if k in pixels.columns})


def with_ndvi(pixels: DataFrame) -> DataFrame:
    """NDVI of every observation."""
    return pixels.withColumn("ndvi", spectral.ndvi(F.col("nir"), F.col("red")))


def with_indices(frame: DataFrame) -> DataFrame:
    """NDVI, NDWI and SAVI of whatever bands the frame holds."""
    nir, red = F.col("nir"), F.col("red")
    return frame.withColumns(
        {"ndvi": spectral.ndvi(nir, red), "ndwi": spectral.ndwi(F.col("green"), nir), "savi": spectral.savi(nir, red)}
    )


def median_composite(pixels: DataFrame, bands: Sequence[str] = BANDS, key: str = "pixel_id") -> DataFrame:
    """Per-pixel median of each band over the scenes, NULLs skipped, then the indices."""
    med = pixels.groupBy(key).agg(*[F.median(b).alias(b) for b in bands])
    return with_indices(med) if {"green", "red", "nir"} <= set(bands) else med


def median_ndvi(pixels: DataFrame, key: str = "pixel_id") -> DataFrame:
    """Median of the per-scene NDVI, clamped: index first, which is another number."""
    med = with_ndvi(pixels).groupBy(key).agg(F.median("ndvi").alias("ndvi"))
    return med.withColumn("ndvi", spectral.clamp(F.col("ndvi"), -1.0, 1.0))


def best_scene(scenes: DataFrame) -> DataFrame:
    """The clearest scene; equal clouds are decided by the id."""
    return scenes.orderBy("cloud", "scene_id").limit(1)


def best_scene_ndvi(pixels: DataFrame, scenes: DataFrame) -> DataFrame:
    """NDVI of the clearest scene, clamped."""
    one = with_ndvi(pixels_of(pixels, best_scene(scenes)))
    return one.withColumn("ndvi", spectral.clamp(F.col("ndvi"), -1.0, 1.0))


def clearest_pixels(pixels: DataFrame, bands: Sequence[str] = BANDS, key: str = "pixel_id") -> DataFrame:
    """Per pixel, the bands of its clearest observation. An aggregate, so it combines on the map side."""
    rest = [b for b in bands if b in pixels.columns]
    pick = F.min(F.struct("cloud", "scene_id", *rest)).alias("_p")
    return pixels.groupBy(key).agg(pick).select(key, "_p.cloud", "_p.scene_id", *[f"_p.{b}" for b in rest])


def cell_of(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    return F.floor(x / F.lit(size)), F.floor(y / F.lit(size))


def sample_at_points(points: DataFrame, raster: DataFrame, bands: Sequence[str], size: float = PIXEL_M) -> DataFrame:
    """Mean of every band in the pixel that holds a point; points off the raster get NULLs."""
    cx, cy = cell_of(F.col("x"), F.col("y"), size)
    cells = (
        raster.select(cx.alias("_cx"), cy.alias("_cy"), *bands)
        .groupBy("_cx", "_cy")
        .agg(*[F.avg(b).alias(b) for b in bands])
    )
    keyed = points.withColumns({"_px": cx, "_py": cy})
    on = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy"))
    return keyed.join(cells, on, "left").drop("_px", "_py", "_cx", "_cy")


def weather_means(readings: DataFrame, season: tuple[str, str] | None = None) -> DataFrame:
    """Mean temperature (K) and precipitation (m) per weather cell (cx, cy)."""
    if season is not None:
        readings = readings.where(
            (F.col("ts") >= F.lit(season[0]).cast("timestamp_ntz")) & (F.col("ts") < F.lit(season[1]).cast("timestamp_ntz"))
        )
    return readings.groupBy("cx", "cy").agg(
        F.avg("temperature_2m").alias("temperature_2m"), F.avg("total_precipitation").alias("total_precipitation")
    )


def attach_weather(points: DataFrame, means: DataFrame, size: float = WEATHER_M) -> DataFrame:
    """Weather of the coarse cell that holds each point, by position on the ground.

    Temperature becomes Celsius and precipitation the humidity stand-in; both stay NULL
    where no cell reports.
    """
    wx, wy = cell_of(F.col("x"), F.col("y"), size)
    m = means.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "temperature_2m", "total_precipitation")
    keyed = points.withColumns({"_wx": wx, "_wy": wy})
    joined = keyed.join(m, (F.col("_wx") == F.col("_cx")) & (F.col("_wy") == F.col("_cy")), "left")
    return joined.select(
        *points.columns,
        spectral.celsius(F.col("temperature_2m")).alias("temperature"),
        spectral.humidity(F.col("total_precipitation")).alias("humidity"),
    )


def complete_cases(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL, in all columns or in the named ones."""
    return frame.na.drop("any", subset=list(columns) if columns else None)


def raster_profile(pixels: DataFrame, band: str = "ndvi") -> DataFrame:
    """Extent, least and greatest value and number of pixels of one band."""
    return pixels.agg(
        F.min("x").alias("x0"),
        F.min("y").alias("y0"),
        F.max("x").alias("x1"),
        F.max("y").alias("y1"),
        F.min(band).alias("min_value"),
        F.max(band).alias("max_value"),
        F.count(band).alias("pixels"),
    )


def display_ndvi(pixels: DataFrame) -> DataFrame:
    """NDVI stretched for display: clipped to [0, 1]."""
    return pixels.withColumn("ndvi", spectral.clamp(F.col("ndvi"), 0.0, 1.0))


def write_ndvi(pixels: DataFrame, path: str, tile_m: float = 10000.0) -> None:
    """Write an NDVI product, clamped and partitioned by tile."""
    tx, ty = cell_of(F.col("x"), F.col("y"), tile_m)
    tile = F.concat_ws("_", tx, ty)
    out = pixels.withColumns({"ndvi": spectral.clamp(F.col("ndvi"), -1.0, 1.0), "tile": tile})
    out.repartition("tile").write.mode("errorifexists").partitionBy("tile").parquet(path)
