"""Captured answers of a map service as a registered data source with filters that reach the reader.

``spark.read.format("captured_places").load(folder)`` gives a row for each element of the JSON answers in a folder. Every file
is a partition. Comparisons of lat, lon, type, id and tag reach the reader: what they exclude never becomes a row, and files
named after their box, ``<south>_<west>_<north>_<east>.json``, that lie off it are not opened. The same filters can be written
as a request to the service (``request``).
"""

from __future__ import annotations

import json
import operator
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from entityspark.functions import taxonomy

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

SCHEMA = "type string, id bigint, lat double, lon double, tags map<string,string>, tag string"
COMPARED: dict[type, Callable[[Any, Any], bool]] = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
WHOLE_WORLD = (-90.0, -180.0, 90.0, 180.0)


@dataclass(frozen=True)
class Test:
    """One pushed filter: a column, how it is compared, and with what."""

    column: str
    kind: str
    value: Any

    def holds(self, row: dict) -> bool:
        own = row[self.column]
        if own is None:
            return False
        if self.kind == "IsNotNull":
            return True
        return own in self.value if self.kind == "In" else {k.__name__: f for k, f in COMPARED.items()}[self.kind](own, self.value)


@dataclass
class Captured(InputPartition):
    path: str


def pushed(filters: Iterable[Filter]) -> tuple[list[Test], list[Filter]]:
    """What the reader can decide itself, and the rest."""
    tests, rest = [], []
    for f in filters:
        name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
        if name not in ("type", "id", "lat", "lon", "tag") or type(f) not in (*COMPARED, In, IsNotNull):
            rest.append(f)
        else:
            tests.append(Test(name, type(f).__name__, tuple(f.value) if isinstance(f, In) else getattr(f, "value", None)))
    return tests, rest


def box(tests: Iterable[Test]) -> tuple[float, float, float, float]:
    """South, west, north and east within which all rows lie."""
    south, west, north, east = WHOLE_WORLD
    for t in tests:
        if t.column not in ("lat", "lon") or t.kind in ("IsNotNull", "In"):
            continue
        least, most = (t.value if t.kind in kinds else None for kinds in (("GreaterThan", "GreaterThanOrEqual", "EqualTo"), ("LessThan", "LessThanOrEqual", "EqualTo")))
        if t.column == "lat":
            south, north = max(south, least if least is not None else south), min(north, most if most is not None else north)
        else:
            west, east = max(west, least if least is not None else west), min(east, most if most is not None else east)
    return south, west, north, east


def wanted_tags(tests: Iterable[Test], known: list[str]) -> list[str]:
    """Of the known tags those that the filters leave."""
    own = [t for t in tests if t.column == "tag"]
    return [k for k in known if all(t.holds({"tag": k}) for t in own)]


def request(tests: list[Test], known: list[str]) -> str:
    """The request for what the filters leave: values of one key as alternatives, within the box."""
    groups: dict[str, list[str]] = {}
    for tag in wanted_tags(tests, known):
        key, value = tag.split("=")
        groups.setdefault(key, []).append(value)
    within = ",".join(f"{v:g}" for v in box(tests))
    lines = [f'  nwr["{k}"~"^({"|".join(vs)})$"]({within});' for k, vs in sorted(groups.items())]
    return "\n".join(["[out:json][timeout:180];", "(", *lines, ");", "out center tags;", ""])


def known_tags() -> list[str]:
    """All tags of segments, each once, in their order."""
    return list(dict.fromkeys(kv for kv, _ in taxonomy.listed(taxonomy.TAGS, " ")))


def file_box(path: str) -> tuple[float, ...] | None:
    found = re.search(r"(?:^|/)(-?[\d.]+)_(-?[\d.]+)_(-?[\d.]+)_(-?[\d.]+)\.json$", path)
    return tuple(map(float, found.groups())) if found else None


class PlacesReader(DataSourceReader):
    def __init__(self, path: str, tags: list[str]):
        self.path, self.tags, self.tests = path, tags, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        self.tests, rest = pushed(filters)
        yield from rest

    def partitions(self) -> list[Captured]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.path)
        south, west, north, east = box(self.tests)
        files = [f.path for f in system.get_file_info(fs.FileSelector(base, recursive=True)) if f.is_file and f.path.endswith(".json")]
        boxed = [(f, file_box(f)) for f in sorted(files)]
        return [Captured(f) for f, b in boxed if b is None or (b[0] <= north and south <= b[2] and b[1] <= east and west <= b[3])]

    def read(self, partition: Captured | None) -> Iterator[tuple]:
        from pyarrow import fs

        if partition is None:  # an empty folder
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        with system.open_input_stream(partition.path) as f:
            answer = json.loads(f.read())
        for e in answer.get("elements") or []:
            tags = {k: v for k, v in (e.get("tags") or {}).items() if isinstance(v, str)}
            middle = e.get("center") or {}
            number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
            row = {"type": e.get("type"), "id": e.get("id"), "lat": number(e.get("lat", middle.get("lat"))), "lon": number(e.get("lon", middle.get("lon"))), "tags": tags, "tag": next((t for t in self.tags if tags.get(t.split("=")[0]) == t.split("=")[1]), None)}
            if all(t.holds(row) for t in self.tests):
                yield tuple(row.values())


class CapturedPlaces(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured_places"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        path = self.options["path"]
        return PlacesReader(path if "://" in path else f"file://{path}", self.options["tags"].split(" ") if self.options.get("tags") else known_tags())


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CapturedPlaces)


def places(spark: SparkSession, path: str) -> DataFrame:
    """(type, id, lat, lon, tags, tag) of all captured elements; ``tag`` is the first tag of a segment that it has. The folder
    may lie in any file system that Arrow opens. An empty folder gives no rows, a file that is no JSON is an error."""
    register(spark)
    return spark.read.format("captured_places").option("tags", " ".join(known_tags())).load(path)
