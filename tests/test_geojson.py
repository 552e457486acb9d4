"""GeoJSON read by blocks against the multi-line reader."""

import json
import random

import pytest

from conftest import rows
from gridlens.sources import geojson


def collection(n, seed=1, **members):
    draw = random.Random(seed)
    ring = lambda: [[draw.uniform(-80, -70), draw.uniform(-18, 0)] for _ in range(draw.randrange(3, 9))]
    features = []
    for k in range(n):
        many = k % 3 == 0
        features.append({
            "type": "Feature", "id": k, "properties": {"IDDIST": "" if k % 11 == 5 else f"{k:06}", "nota": draw.choice(
                ["", "a } b", "{", "\"quoted\" {", "back\\slash\\", "\\\"}{", "ñ [,]", "{\"x\": {}}"]), "extra": {"a": {"b": [1, {"c": "}"}]}}},
            "geometry": None if k % 13 == 7 else {"type": "MultiPolygon" if many else "Polygon",
                                                  "coordinates": [[ring()], [ring(), ring()]] if many else [ring(), ring()]}})
    return {"type": "FeatureCollection", **members, "features": features}


def both(spark, path):
    blocks = sorted(map(repr, rows(geojson.read_large_geojson(spark, path))))
    assert blocks == sorted(map(repr, rows(geojson.read_geojson_features(spark, path))))
    return blocks


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_a_file_of_many_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "d.geojson"
    path.write_text(json.dumps(collection(150)))
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
    assert len(both(spark, str(path))) > 120


def test_layouts(spark, tmp_path, small_blocks):
    crs = {"type": "name", "properties": {"name": "urn:{x}", "\"features\": [": "}"}}
    made = collection(20, 2, crs=crs, name="a { b } \"c\"")
    made["after"] = {"z": {"y": 1}}
    (tmp_path / "a.geojson").write_text(json.dumps(made, indent=2) + "\n")
    both(spark, str(tmp_path / "a.geojson"))
    (tmp_path / "b.geojson").write_text(json.dumps(collection(1), ensure_ascii=False))
    both(spark, str(tmp_path / "b.geojson"))
    (tmp_path / "c.geojson").write_text(json.dumps(collection(0)))
    assert both(spark, str(tmp_path / "c.geojson")) == []
    # Several files at once.
    both(spark, str(tmp_path))
