"""The seven register queries.

Every function takes only the tables that it joins. Dimension sides are left to the
optimiser: it broadcasts one only while its measured size is under the configured limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINEL = "—"


def parcels_with_soil(parcel: DataFrame, soil: DataFrame, low: float = 6.0, high: float = 7.5) -> DataFrame:
    """Parcels on soil whose pH lies in the closed range, largest first."""
    p, s = parcel.alias("p"), soil.alias("s")
    return (
        p.join(s, F.col("p.soil_id") == F.col("s.id"))
        .where(F.col("s.ph").between(low, high))
        .select("p.number", "p.area_ha", F.col("s.name").alias("soil_name"), "s.ph")
        .orderBy(F.desc("area_ha"), "number")
    )


def crops_with_owner(crop: DataFrame, parcel: DataFrame, owner: DataFrame, status: str = "aktivan") -> DataFrame:
    """Crops of one status with their parcel and its owner, by crop name."""
    c, p, o = crop.alias("c"), parcel.alias("p"), owner.alias("o")
    return (
        c.where(F.col("c.status") == status)
        .join(p, F.col("c.parcel_id") == F.col("p.id"))
        .join(o, F.col("p.owner_id") == F.col("o.id"))
        .select(
            F.col("c.name").alias("crop_name"),
            "c.variety",
            "p.number",
            "o.first_name",
            "o.last_name",
            F.col("o.kind").alias("owner_kind"),
        )
        .orderBy("crop_name", "number", "variety")
    )


def low_ndvi(monitoring: DataFrame, crop: DataFrame, limit: float = 0.75) -> DataFrame:
    """Monitoring rows strictly under an NDVI limit, lowest first."""
    m, c = monitoring.alias("m"), crop.alias("c")
    return (
        m.where(F.col("m.ndvi") < F.lit(limit))
        .join(c, F.col("m.crop_id") == F.col("c.id"))
        .select(F.col("c.name").alias("crop_name"), "m.day", "m.ndvi", "m.health", "m.problems")
        .orderBy("ndvi", "day", "crop_name")
    )


def parcels_by_municipality(
    parcel: DataFrame, municipality: DataFrame, crop: DataFrame, district: str = "Sremski"
) -> DataFrame:
    """Parcels of one district, with crops where there are any."""
    p, m, c = parcel.alias("p"), municipality.alias("m"), crop.alias("c")
    return (
        p.join(m.where(F.col("m.district") == district), F.col("p.municipality_id") == F.col("m.id"))
        .join(c, F.col("p.id") == F.col("c.parcel_id"), "left")
        .select(
            F.col("m.name").alias("municipality_name"),
            "m.district",
            "p.number",
            F.col("c.name").alias("crop_name"),
            "c.status",
        )
        .orderBy("municipality_name", "number", "crop_name")
    )


def owner_totals(owner: DataFrame, parcel: DataFrame, over: float | Column = 3.0) -> DataFrame:
    """Owners whose parcels add up to more than a limit.

    Areas are summed per owner key before the join, so a large owner costs one
    partial sum per map task and the shuffle carries one row per owner and task.
    """
    totals = (
        parcel.groupBy("owner_id")
        .agg(F.count("id").alias("parcels"), F.sum("area_ha").alias("total_area_ha"))
        .where(F.col("total_area_ha") > over)
    )
    o = owner.alias("o")
    return (
        o.join(totals, F.col("o.id") == totals["owner_id"])
        .select("o.id", "o.first_name", "o.last_name", F.col("o.kind").alias("owner_kind"), "parcels", "total_area_ha")
        .orderBy(F.desc("total_area_ha"), "id")
    )


def irrigated_crops(
    crop: DataFrame, parcel: DataFrame, soil: DataFrame, owner: DataFrame, municipality: DataFrame
) -> DataFrame:
    """Irrigated crops with soil, owner and municipality, by drainage class."""
    c, p, s, o, m = (f.alias(a) for f, a in zip((crop, parcel, soil, owner, municipality), "cpsom"))
    return (
        c.where(F.col("c.irrigated"))
        .join(p, F.col("c.parcel_id") == F.col("p.id"))
        .join(s, F.col("p.soil_id") == F.col("s.id"))
        .join(o, F.col("p.owner_id") == F.col("o.id"))
        .join(m, F.col("p.municipality_id") == F.col("m.id"))
        .select(
            F.col("c.name").alias("crop_name"),
            F.col("s.name").alias("soil_name"),
            "s.drainage",
            F.col("o.first_name").alias("owner_name"),
            "o.email",
            F.col("m.name").alias("municipality_name"),
        )
        .orderBy("drainage", "soil_name", "email", "crop_name")
    )


def treatments(monitoring: DataFrame, crop: DataFrame, parcel: DataFrame, municipality: DataFrame) -> DataFrame:
    """Monitoring rows with a real treatment, newest first.

    A dash marks "none" in the stored data; it is not NULL and is dropped as well.
    """
    n, c, p, m = (f.alias(a) for f, a in zip((monitoring, crop, parcel, municipality), "ncpm"))
    return (
        n.where(F.col("n.treatment").isNotNull() & (F.col("n.treatment") != SENTINEL))
        .join(c, F.col("n.crop_id") == F.col("c.id"))
        .join(p, F.col("c.parcel_id") == F.col("p.id"))
        .join(m, F.col("p.municipality_id") == F.col("m.id"))
        .select(
            "n.day",
            "n.operator",
            "n.treatment",
            F.col("c.name").alias("crop_name"),
            "c.variety",
            "p.number",
            F.col("p.address").alias("parcel_address"),
            "m.town",
        )
        .orderBy(F.desc("day"), "number", "crop_name")
    )


def register_queries(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven, as lazy frames over one set of tables."""
    t = tables
    return {
        "parcels_with_soil": parcels_with_soil(t["parcel"], t["soil_type"]),
        "crops_with_owner": crops_with_owner(t["crop"], t["parcel"], t["owner"]),
        "low_ndvi": low_ndvi(t["monitoring"], t["crop"]),
        "parcels_by_municipality": parcels_by_municipality(t["parcel"], t["municipality"], t["crop"]),
        "owner_totals": owner_totals(t["owner"], t["parcel"]),
        "irrigated_crops": irrigated_crops(t["crop"], t["parcel"], t["soil_type"], t["owner"], t["municipality"]),
        "treatments": treatments(t["monitoring"], t["crop"], t["parcel"], t["municipality"]),
    }
