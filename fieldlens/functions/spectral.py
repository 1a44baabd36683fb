"""Band arithmetic, weather units and label rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), NULL where the sum is 0."""
    return F.try_divide(a - b, a + b)


def ndvi(nir: Column, red: Column) -> Column:
    return normalised_difference(nir, red)


def ndwi(green: Column, nir: Column) -> Column:
    return normalised_difference(green, nir)


def savi(nir: Column, red: Column) -> Column:
    return F.try_divide((nir - red) * F.lit(1.5), nir + red + F.lit(0.5))


def clamp(c: Column, low: float, high: float) -> Column:
    """Into [low, high]; NULL stays NULL, which greatest and least alone would not keep."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(273.15)


def humidity(precipitation: Column) -> Column:
    """A stand-in for relative humidity from mean precipitation in metres."""
    return clamp(precipitation * F.lit(100000.0) / F.lit(7.0), 20.0, 95.0)


# The class rules in the order in which they are tried, and the colours.
CLASSES = ("Pšenica", "Kukuruz", "Suncokret", "Soja", "Ječam", "Krompir")
COLOURS = {
    "Pšenica": "#F5DEB3",
    "Kukuruz": "#FFD700",
    "Suncokret": "#FFA500",
    "Soja": "#32CD32",
    "Ječam": "#DEB887",
    "Krompir": "#8B4513",
}
NO_COLOUR = "#999"


MIX_SPAN = 2147483629
_FIELD = 2147483647


def mix(key: Column, seed: int) -> Column:
    """A repeatable scatter of integer keys over [0, MIX_SPAN), the same in any SQL engine.

    Two rounds modulo different primes, the second with a square, so that neighbouring keys
    share no residue class and few keys meet.
    """
    k = key.cast("long")
    low, high = F.pmod(k, F.lit(_FIELD)), F.pmod(F.shiftright(k, 31), F.lit(_FIELD))
    first = F.pmod(low * F.lit(48271) + high * F.lit(40503) + F.lit(seed * 7919 + 1), F.lit(_FIELD))
    return F.pmod(F.pmod(first * first, F.lit(MIX_SPAN)) * F.lit(69621) + first, F.lit(MIX_SPAN))


def rule_label(ndvi: Column, nir: Column, red: Column, swir: Column, ndwi: Column, key: Column, seed: int = 42) -> Column:
    """Crop class by the first rule that holds.

    The sixth rule can never fire, since the third holds wherever it does; it is kept so
    that the order is the known one. Where no rule holds, the class follows from the key.
    """
    other = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (F.pmod(mix(key, seed), F.lit(6)) + 1).cast("int"))
    return (
        F.when((ndvi > 0.78) & (nir > 0.45), "Kukuruz")
        .when((ndvi > 0.76) & (ndwi < 0.1), "Soja")
        .when((ndvi > 0.70) & (ndwi > 0.1), "Pšenica")
        .when((swir > 0.25) & (ndvi < 0.65), "Suncokret")
        .when((ndvi < 0.65) & (red > 0.08), "Ječam")
        .when((ndvi > 0.72) & (ndwi > 0.15), "Krompir")
        .otherwise(other)
    )


def class_colour(crop: Column) -> Column:
    pairs = [x for k, v in COLOURS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), crop), F.lit(NO_COLOUR))
