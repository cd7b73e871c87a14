"""Captured places: what is pushed, what is opened, and that results are the same without it."""

import json
import random

import pytest
from pyspark.sql import functions as F

from entityspark.sources import places


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rnd, base = random.Random(6), tmp_path_factory.mktemp("places")
    for south in (44, 45):
        for west in (33, 34):
            elements = []
            for k in range(40):
                point = {"lat": south + rnd.random(), "lon": west + rnd.random()}
                where = [point, {"center": point}, {}][rnd.choice([0, 0, 1, 1, 2])]
                elements.append({"type": rnd.choice(["node", "way"]), "id": south * 1000 + west * 100 + k, "tags": rnd.choice([{"shop": "car", "name": "А"}, {"amenity": "clinic"}, {"x": "y"}, {}]), **where})
            (base / f"{south}_{west}_{south + 1}_{west + 1}.json").write_text(json.dumps({"elements": elements}), encoding="utf-8")
    (base / "rest.json").write_text('{"elements": [{"type": "node", "id": 1, "lat": 44.5, "lon": 33.5, "tags": {"office": "it", "n": 5}}, {"type": "node", "id": 2}]}')
    (base / "empty.json").write_text("{}")
    return str(base)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("condition", ["lat >= 44.9 AND lat < 45.2 AND lon > 33.5", "tag IN ('shop=car', 'office=it') AND lon <= 34", "type = 'way' AND tag IS NOT NULL", "lat = 44.5", "lat > 80", "id % 2 = 0 AND lat < 45", "tags['name'] = 'А'"])
def test_pushed_filters_change_no_result(spark, folder, condition):
    rows = [tuple(r) for r in places.places(spark, folder).selectExpr("id", "type", "lat", "lon", "tag", "tags['name'] AS name").collect()]
    all_ = spark.createDataFrame(rows, "id long, type string, lat double, lon double, tag string, name string")
    expected = {r["id"] for r in all_.filter(condition.replace("tags['name']", "name")).collect()}
    assert {r["id"] for r in places.places(spark, folder).filter(condition).collect()} == expected


def test_filters_reach_the_reader_and_close_files(spark, folder):
    df = places.places(spark, folder).filter((F.col("lat") > 45.1) & (F.col("lon") <= 33.9) & (F.col("tag") == "shop=car"))
    assert "FilterExec" not in plan(df) and "Filter (" not in plan(df)  # nothing is left for Spark to test
    assert df.rdd.getNumPartitions() == 3  # one tile, and the two files that tell no box
    assert places.places(spark, folder).rdd.getNumPartitions() == 6


def test_request_has_the_filters():
    tests = [places.Test("lat", "GreaterThanOrEqual", 44.0), places.Test("lat", "LessThan", 46.5), places.Test("lon", "GreaterThan", 33), places.Test("tag", "In", ("shop=car", "shop=beauty", "amenity=clinic", "x=y"))]
    assert places.request(tests, places.known_tags()).splitlines()[2:4] == ['  nwr["amenity"~"^(clinic)$"](44,33,46.5,180);', '  nwr["shop"~"^(car|beauty)$"](44,33,46.5,180);']


def test_empty_folder(spark, tmp_path):
    assert places.places(spark, str(tmp_path)).collect() == []


def test_captured_answers_as_observations(spark, folder):
    from entityspark.sources import readers

    names = ["source_id", "name", "city", "latitude", "longitude", "raw_category"]
    found = {tuple(r) for r in readers.captured(spark, folder).select(*names).collect()}
    assert found == {tuple(r) for r in readers.osm(spark, folder).select(*names).collect()} and found
