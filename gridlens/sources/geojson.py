"""District polygons from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridlens.session import settle

# Coordinates nest to a different depth per geometry type, so they are read as text first.
MEMBERS = "properties struct<IDDIST: string>, geometry struct<type: string, coordinates: string>"
COLLECTION = (
    "features array<struct<properties: struct<IDDIST: string>, geometry: struct<type: string, coordinates: string>>>"
)
POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = f"array<{POLYGON}>"


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature with a code: (posicion, IDDIST, tipo, puntos), the points of all outer rings.

    A file is one JSON value and is read by one task. ``read_large_geojson`` reads a file by many.
    """
    collection = spark.read.schema(COLLECTION).option("multiLine", True).json(path)
    return _outlines(collection.select(F.posexplode("features").alias("posicion", "_f")))


def _outlines(features: DataFrame) -> DataFrame:
    """``features``: posicion, _f."""
    kind, text = F.col("_f.geometry.type"), F.col("_f.geometry.coordinates")
    polygon = F.element_at(F.from_json(text, POLYGON), 1)
    outer = F.flatten(F.transform(F.from_json(text, MULTIPOLYGON), lambda part: F.element_at(part, 1)))
    return features.select(
        "posicion", F.col("_f.properties.IDDIST").alias("IDDIST"), kind.alias("tipo"),
        F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", outer).alias("puntos"),
    ).filter((F.coalesce("IDDIST", F.lit("")) != "") & (F.size("puntos") > 0))


# An escaped character of a string; what may stand before an object without opening one.
ESCAPED = r"\\."
LEADING = r'^(?:[^{"]++|"(?:[^"\\]++|\\.)*+")*+'


def _before(df: DataFrame, measure: str, name: str) -> DataFrame:
    """``df`` with the sum of ``measure`` over all earlier pieces of the file. Pieces are added up where they lie; one row for
    each block of a file travels."""
    blocks = df.groupBy("file", "block").agg(F.sum(measure).alias("_all"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("_inside", F.coalesce(F.sum(measure).over(inside), F.lit(0)))
    return summed.join(blocks, ["file", "block"]).withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside")


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """file, posicion, texto of every element of the ``features`` of collections, each file read by many tasks.

    Files are cut at every closing brace, wherever they are split into blocks. Sums over the earlier pieces say whether a piece
    begins within a string, how deep its braces lie, and to which object it belongs; its pieces are put together again.
    """
    cut = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    pieces = settle(cut, "json-pieces")
    plain = F.regexp_replace("text", ESCAPED, "")
    quotes = (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).cast("long")
    pieces = _before(pieces.withColumn("quotes", quotes), "quotes", "_quotes")
    # Parts between quotes lie outside and inside of strings in turn.
    outside = F.array_join(F.filter(F.split(plain, '"'), lambda part, i: (i + F.col("_quotes")) % 2 == 0), "")
    opened = F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))
    closes = (F.col("_quotes") + F.col("quotes")) % 2 == 0
    deeper = pieces.withColumn("closes", closes).withColumn("deeper", (opened - closes.cast("int")).cast("long"))
    deep = settle(_before(deeper, "deeper", "_deep"), "json-depths")
    ended = (F.col("closes") & (F.col("_deep") + F.col("deeper") == 1)).cast("long")
    numbered = _before(deep.withColumn("ended", ended), "ended", "object")
    whole = numbered.groupBy("file", "object").agg(
        F.max("ended").alias("ended"), F.array_sort(F.collect_list(F.struct("block", "id", "text"))).alias("parts"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    # The first object of a file stands within the collection's own brace.
    inner = F.when(F.col("object") == 0, F.regexp_replace(text, LEADING + r"\{", "")).otherwise(text)
    objects = settle(whole.filter("ended = 1").select("file", "object", inner.alias("text")).select(
        "file", "object", F.regexp_replace("text", LEADING, "").alias("texto"),
        F.regexp_extract("text", LEADING, 0).alias("lead")), "json-objects")
    first = objects.filter(F.col("lead").rlike(r'"features"\s*:\s*\[\s*$')).groupBy("file").agg(F.min("object").alias("first"))
    placed = objects.join(first, "file").filter(F.col("object") >= F.col("first"))
    other = placed.filter((F.col("object") > F.col("first")) & ~F.col("lead").rlike(r"^\s*,\s*$"))
    last = other.groupBy("file").agg(F.min("object").alias("last"))
    inside = placed.join(last, "file", "left").filter(F.col("last").isNull() | (F.col("object") < F.col("last")))
    return inside.select("file", (F.col("object") - F.col("first")).cast("int").alias("posicion"), "texto")


def read_large_geojson(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as ``read_geojson_features``, with every file read by many tasks. Braces within strings are told from
    others; elements of ``features`` that are no objects are not counted."""
    return _outlines(feature_texts(spark, path).select("posicion", F.from_json("texto", MEMBERS).alias("_f")))


def _mean_of(points: Column, axis: int) -> Column:
    total = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + F.element_at(p, axis))
    return total / F.size(points)


def district_centroids(features: DataFrame) -> DataFrame:
    """Mean latitude and longitude of a feature's outer vertices; the last feature of a code counts."""
    centre = features.select("posicion", "IDDIST", F.struct(
        _mean_of(F.col("puntos"), 2).alias("lat"), _mean_of(F.col("puntos"), 1).alias("lon")
    ).alias("_c"))
    return centre.groupBy("IDDIST").agg(F.max_by("_c", "posicion").alias("_c")).select("IDDIST", "_c.lat", "_c.lon")
