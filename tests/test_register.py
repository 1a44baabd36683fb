"""The seven register queries, changes and rules on a six-row register."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import changes, integrity
from fieldlens.plans.register import register_queries
from fieldlens.sources.schemas import LINKS, REGISTER

D = Decimal


def _frame(spark, name, rows):
    """Rows as dicts; columns that are not given are NULL."""
    table = REGISTER[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in table.fields) for r in rows], table.struct)


@pytest.fixture(scope="module")
def tables(spark):
    soil = [(1, "6.8", "Dobra"), (2, "7.0", "Umerena"), (3, "5.5", "Dobra"), (4, "6.2", "Slaba"), (5, "7.5", "Odlična"), (6, "5.0", "Slaba")]
    parcel = [
        (1, "P-001", "3.55", 1, 1, 1), (2, "P-002", "5.20", 2, 2, 2), (3, "P-003", "2.80", 3, 3, 3),
        (4, "P-004", "4.10", 5, 4, 4), (5, "P-005", "6.75", 4, 5, 1), (6, "P-006", "3.30", 6, 6, 5),
    ]
    crop = [
        (1, 1, "Pšenica", "aktivan", False), (2, 2, "Kukuruz", "aktivan", True), (3, 3, "Suncokret", "aktivan", False),
        (4, 4, "Soja", "aktivan", True), (5, 5, "Ječam", "zavrsen", False), (6, 6, "Krompir", "aktivan", True),
    ]
    seen = [
        (1, date(2025, 3, 15), ".75", "Prihrana"), (2, date(2025, 5, 10), ".82", "—"), (3, date(2025, 5, 15), ".68", "Fungicid"),
        (4, date(2025, 6, 1), ".88", "Navodnjavanje"), (5, date(2025, 4, 1), ".70", "—"), (5, date(2025, 5, 20), ".60", "Hitno navodnjavanje"),
    ]
    return {
        "soil_type": _frame(spark, "soil_type", [dict(id=i, name=f"S{i}", ph=D(p), drainage=x) for i, p, x in soil]),
        "municipality": _frame(spark, "municipality", [dict(id=i, name=f"M{i}", district="Sremski", code=f"C{i}") for i in range(1, 7)]),
        "owner": _frame(spark, "owner", [dict(id=i, national_no=f"N{i}", first_name=f"O{i}", last_name="X") for i in range(1, 7)]),
        "parcel": _frame(
            spark, "parcel",
            [dict(id=i, number=n, area_ha=D(a), municipality_id=m, owner_id=o, soil_id=s) for i, n, a, m, o, s in parcel],
        ),
        "crop": _frame(spark, "crop", [dict(id=i, parcel_id=p, name=n, status=s, irrigated=w) for i, p, n, s, w in crop]),
        "monitoring": _frame(
            spark, "monitoring",
            [dict(id=k, crop_id=c, day=day, ndvi=D(v), treatment=t) for k, (c, day, v, t) in enumerate(seen, 1)],
        ),
    }


def _col(frame, name):
    return [r[name] for r in frame.select(name).collect()]


def test_seven_queries(tables):
    q = register_queries(tables)
    assert _col(q["parcels_with_soil"], "number") == ["P-005", "P-002", "P-004", "P-001", "P-006"]
    assert _col(q["crops_with_owner"], "crop_name") == ["Krompir", "Kukuruz", "Pšenica", "Soja", "Suncokret"]
    assert [(float(r.ndvi), r.crop_name) for r in q["low_ndvi"].collect()] == [(0.6, "Ječam"), (0.68, "Suncokret"), (0.7, "Ječam")]
    assert q["parcels_by_municipality"].count() == 6
    assert _col(q["owner_totals"], "id") == [5, 2, 4, 1, 6]
    assert sorted(_col(q["irrigated_crops"], "crop_name")) == ["Krompir", "Kukuruz", "Soja"]
    assert [str(x) for x in _col(q["treatments"], "day")] == ["2025-06-01", "2025-05-20", "2025-05-15", "2025-03-15"]


def test_left_join_keeps_parcel_without_crop(tables):
    lonely = dict(tables, crop=tables["crop"].where("id <> 3"))
    rows = register_queries(lonely)["parcels_by_municipality"].collect()
    assert len(rows) == 6 and [r.number for r in rows if r.crop_name is None] == ["P-003"]


def test_cascade_and_set_null(spark, tables):
    gone = changes.delete_with_rules(tables, "municipality", spark.createDataFrame([(4,)], "id long"), REGISTER)
    assert 5 not in _col(gone["parcel"], "id") and 5 not in _col(gone["crop"], "id")
    assert gone["monitoring"].count() == 4
    freed = changes.delete_with_rules(tables, "owner", spark.createDataFrame([(1,)], "id long"), REGISTER)
    assert freed["parcel"].where("id = 1").first().owner_id is None and freed["parcel"].count() == 6


def test_insert_fills_defaults(spark, tables):
    new = spark.createDataFrame([(7, 1, "Lucerka")], "id long, parcel_id long, name string")
    row = changes.insert_rows(tables["crop"], new, REGISTER["crop"]).where("id = 7").first()
    assert (row.status, row.irrigated, row.sown) == ("aktivan", False, None)


def test_update_delete_null_rules(spark, tables):
    crop = tables["crop"].withColumn("variety", F.when(F.col("id") == 1, "A").when(F.col("id") == 2, "B"))
    kept = changes.delete_where(crop, REGISTER["crop"], "variety", "A")
    assert kept.count() == 5
    moved = changes.update_where(crop, REGISTER["crop"], "status", "zavrsen", "variety", "B")
    assert _col(moved.where("id = 2"), "status") == ["zavrsen"] and moved.where("status = 'zavrsen'").count() == 2
    with pytest.raises(ValueError):
        changes.delete_where(crop, REGISTER["crop"], "id; drop table", 1)


def test_repeated_update_keeps_one_row(spark, tables):
    crop = tables["crop"]
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (99, "c")], "id long, status string")
    out = changes.update_batch(crop, REGISTER["crop"], batch)
    assert out.count() == 6 and _col(out.where("id = 1"), "status") == ["b"]


def test_upsert_last_change_wins(spark, tables):
    crop = tables["crop"]
    rows = crop.where("id in (1, 2)").withColumns({"status": F.lit("x"), "seq": F.lit(1), "action": F.lit("update")})
    later = rows.where("id = 2").withColumns({"seq": F.lit(2), "action": F.lit("delete")})
    ghost = rows.where("id = 1").withColumn("id", F.lit(99).cast("long"))
    out = changes.upsert(crop, rows.unionByName(later).unionByName(ghost), REGISTER["crop"])
    assert sorted(_col(out, "id")) == [1, 3, 4, 5, 6] and _col(out.where("id = 1"), "status") == ["x"]


def test_integrity_finds_planted_faults(spark, tables):
    bad = dict(tables)
    bad["crop"] = tables["crop"].unionByName(tables["crop"].where("id = 1").withColumns({"parcel_id": F.lit(77).cast("long"), "name": F.lit(None).cast("string")}))
    found = {(r.table_name, r.check_name, r.column_name): r.violations for r in integrity.integrity_report(bad, REGISTER, LINKS).collect()}
    assert found[("crop", "foreign_key", "parcel_id")] == 1
    assert found[("crop", "not_null", "name")] == 1
    assert found[("crop", "unique", "id")] == 1
    assert sum(v for k, v in found.items() if k[0] != "crop") == 0
