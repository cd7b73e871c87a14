"""Coordinates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.text import blank, let, one_space
from entityspark.functions.values import CITY_ALIASES, CITY_BOXES, CITY_HINTS, CONTOUR, CONTOUR_BOX

EARTH_KM = 6371.0088


def coordinate(c: Column, most: float) -> Column:
    value = F.replace(blank(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.abs(value) <= most, value)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.when(h.isNotNull(), EARTH_KM * 2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))  # least() passes over nulls


def city_of(lat: Column, lon: Column, boxes: list[tuple] = CITY_BOXES) -> Column:
    """The first box that holds the point, else empty."""
    table = F.array(*[F.struct(F.lit(n).alias("n"), *[F.lit(float(v)).alias(k) for k, v in zip("abcd", box, strict=True)]) for n, *box in boxes])
    holds = lambda p: F.filter(table, lambda x: p["lat"].between(x["a"], x["b"]) & p["lon"].between(x["c"], x["d"]))
    return F.coalesce(let(F.struct(lat.alias("lat"), lon.alias("lon")), lambda p: F.get(holds(p), F.lit(0))["n"]), F.lit(""))


def inside(lat: Column, lon: Column, polygon: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the edges of a polygon of (lat, lon) corners."""
    crossings = F.lit(0)
    for (a, b), (c, d) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        if a != c:  # level edges are never crossed
            crossings = crossings + (((F.lit(a) > lat) != (F.lit(c) > lat)) & (lon < (d - b) * (lat - a) / (c - a) + b)).cast("int")
    return crossings % 2 == 1


def in_contour(lat: Column, lon: Column) -> Column:
    """Whether a point lies on the peninsula; false where there is none."""
    south, north, west, east = CONTOUR_BOX
    within = lambda p: F.coalesce((p["lat"].between(south, north) & p["lon"].between(west, east)) | inside(p["lat"], p["lon"], CONTOUR), F.lit(False))
    return let(F.struct(lat.alias("lat"), lon.alias("lon")), within)


def city_name(c: Column) -> Column:
    """Known spellings of a city as one; others stay."""
    bare = one_space(c)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CITY_ALIASES.items() for x in kv]), F.lower(bare)), bare)


def hinted_city(c: Column, fold_case: bool = True) -> Column:
    """The first known city that a text holds; null for none."""
    hints = F.array(*map(F.lit, CITY_HINTS))
    known = (lambda x: F.filter(hints, lambda h: F.lower(x).contains(F.lower(h)))) if fold_case else (lambda x: F.filter(hints, lambda h: x.contains(h)))
    return let(c, lambda x: F.get(known(x), F.lit(0)))


def cells(lat: Column, lon: Column) -> Column:
    """The hundredth-degree cell of a point and its eight neighbours."""
    near = F.sequence(F.lit(-1), F.lit(1))
    keys = F.transform(near, lambda i: F.transform(near, lambda j: F.concat_ws(":", F.lit("geo"), F.floor(lat * 100) + i, F.floor(lon * 100) + j)))
    return F.flatten(keys)
