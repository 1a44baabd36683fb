"""Declared tables of the land register and the rules that hold between them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
SHAPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(POINT))),
    ]
)
BOX = ("x0", "y0", "x1", "y1")


@dataclass(frozen=True)
class Field:
    """A column with the constraints that an integrity job checks."""

    name: str
    type: T.DataType
    required: bool = False
    max_len: int | None = None
    default: object = None

    def default_column(self) -> Column:
        if callable(self.default):
            return self.default().cast(self.type)
        return F.lit(self.default).cast(self.type)


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: str = "id"
    unique: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def check_column(self, name: str) -> str:
        if name not in self.columns:
            raise ValueError(f"table {self.name} has no column {name!r}")
        return name


@dataclass(frozen=True)
class Link:
    """A foreign key and what happens to the child when the parent goes."""

    child: str
    column: str
    parent: str
    rule: str = field(default="cascade")  # or "set_null"


LONG, INT, TEXT, BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
DAY, TIME = T.DateType(), T.TimestampType()


def _num(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _text(name: str, n: int, required: bool = False, default: object = None) -> Field:
    return Field(name, TEXT, required, n, default)


SOIL_TYPE = Table(
    "soil_type",
    (
        Field("id", LONG, True),
        _text("name", 100, True),
        Field("description", TEXT),
        Field("ph", _num(3, 1)),
        Field("organic_pct", _num(5, 2)),
        _text("drainage", 50),
        _text("suited_for", 100),
        _text("colour", 50),
        _text("texture", 50),
        Field("entered_at", TIME, default=F.current_timestamp),
    ),
)

MUNICIPALITY = Table(
    "municipality",
    (
        Field("id", LONG, True),
        _text("name", 150, True),
        _text("district", 100),
        _text("town", 100),
        Field("area_ha", _num(10, 2)),
        Field("parcels", INT),
        _text("code", 20),
        Field("note", TEXT),
        Field("founded", DAY),
        Field("active", BOOL, default=True),
    ),
    unique=("code",),
)

OWNER = Table(
    "owner",
    (
        Field("id", LONG, True),
        _text("national_no", 13),
        _text("first_name", 100, True),
        _text("last_name", 100, True),
        _text("address", 200),
        _text("phone", 30),
        _text("email", 100),
        _text("kind", 30, default="fizicko_lice"),
        Field("registered", DAY),
        Field("active", BOOL, default=True),
    ),
    unique=("national_no",),
)

PARCEL = Table(
    "parcel",
    (
        Field("id", LONG, True),
        _text("number", 50, True),
        Field("area_ha", _num(10, 4), True),
        Field("shape", SHAPE),
        Field("municipality_id", LONG),
        Field("owner_id", LONG),
        Field("soil_id", LONG),
        _text("address", 200),
        Field("altitude", INT),
        Field("slope_pct", _num(5, 2)),
        Field("entered", DAY, default=F.current_date),
    ),
)

CROP = Table(
    "crop",
    (
        Field("id", LONG, True),
        Field("parcel_id", LONG),
        _text("name", 100, True),
        _text("variety", 100),
        Field("sown", DAY),
        Field("harvested", DAY),
        Field("expected_t", _num(8, 2)),
        _text("status", 30, default="aktivan"),
        Field("irrigated", BOOL, default=False),
        _text("kind", 50),
        Field("note", TEXT),
    ),
)

MONITORING = Table(
    "monitoring",
    (
        Field("id", LONG, True),
        Field("crop_id", LONG),
        Field("day", DAY, True, default=F.current_date),
        Field("ndvi", _num(5, 4)),
        Field("lai", _num(5, 2)),
        _text("health", 50),
        Field("problems", TEXT),
        _text("treatment", 200),
        _text("source", 100),
        _text("operator", 100),
        Field("shape", SHAPE),
    ),
)

DETECTION = Table(
    "detection",
    (
        Field("detection_id", LONG, True),
        _text("crop_type", 100),
        Field("confidence", _num(5, 1)),
        Field("ndvi_mean", _num(5, 4)),
        Field("lai_estimate", _num(4, 1)),
        Field("area_ha", _num(10, 4)),
        Field("latitude", _num(10, 6)),
        Field("longitude", _num(10, 6)),
        Field("temperature", _num(5, 1)),
        Field("humidity", _num(5, 1)),
        _text("detection_method", 100),
        _text("color", 10),
        Field("shape", SHAPE),
        Field("created_at", TIME, default=F.current_timestamp),
    ),
    key="detection_id",
)

REGISTER: dict[str, Table] = {
    t.name: t for t in (SOIL_TYPE, MUNICIPALITY, OWNER, PARCEL, CROP, MONITORING)
}

LINKS: tuple[Link, ...] = (
    Link("parcel", "municipality_id", "municipality"),
    Link("parcel", "owner_id", "owner", "set_null"),
    Link("parcel", "soil_id", "soil_type", "set_null"),
    Link("crop", "parcel_id", "parcel"),
    Link("monitoring", "crop_id", "crop"),
)
