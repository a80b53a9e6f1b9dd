"""Feature collections, tags and tables in pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = "array<array<array<double>>>"
FEATURES = "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"


def json_tags(x: Column) -> Column:
    """A JSON object as an open map of text."""
    return F.from_json(x, "map<string,string>")


def points(coordinates: Column) -> Column:
    """array<struct<x, y>> of positions; a third number is dropped."""
    return F.transform(coordinates, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def parts(kind: Column, coordinates: Column) -> Column:
    """The lines of a geometry whose coordinates are JSON text; other kinds and null have none."""
    one = F.array(F.from_json(coordinates, "array<array<double>>"))
    many = F.from_json(coordinates, _LINES)
    lines = F.when(kind == "LineString", one).when(kind == "MultiLineString", many).otherwise(F.array().cast(_LINES))
    return F.transform(lines, lambda line: points(line))


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header, all text."""
    return spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns), multiLine=True, escape='"')


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(ord, properties, kind, parts) of the features of GeoJSON files, in their order, without those that have no geometry."""
    rows = spark.read.schema(FEATURES).json(path, multiLine=True).select(F.posexplode("features").alias("ord", "f"))
    kept = rows.where(F.col("f.geometry.type").isNotNull())
    return kept.select("ord", "f.properties", F.col("f.geometry.type").alias("kind"), parts(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("parts"))


def esri_parts(paths: Column) -> Column:
    """Paths of two points at least; null where there are none."""
    kept = F.filter(paths, lambda p: F.size(p) > 1)
    return F.when(F.size(kept) > 0, F.transform(kept, lambda p: points(p)))


def osm_features(elements: DataFrame) -> DataFrame:
    """(osm_id, tags, pts) of ways of two points at least, from elements (id, tags, geometry of lon and lat), named or not."""
    kept = elements.where(F.size("geometry") >= 2)
    tags = F.map_concat(F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, _: k != "osm_id"), F.create_map(F.lit("osm_id"), F.col("id").cast("string")))
    return kept.select(F.col("id").alias("osm_id"), tags.alias("tags"), F.transform("geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))).alias("pts"))


def named_ways(elements: DataFrame) -> DataFrame:
    """``osm_features`` of the ways that have a name: streets."""
    return osm_features(elements.where(F.coalesce(F.col("tags")["name"], F.lit("")) != ""))


def html_cells(html: Column, tag: str) -> Column:
    """The texts of a tag's elements, without the tags inside them."""
    found = F.regexp_extract_all(html, F.lit(rf"<{tag}(?: [^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return F.transform(found, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"\s+", " ")))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def pages_with(words: DataFrame, lines: DataFrame, text: str, marker: str, page: str = "page") -> DataFrame:
    """Words of the pages some line of which holds the marker; a page is one flag, however long its text."""
    marked = lines.groupBy(page).agg(F.max(F.contains(F.col(text), F.lit(marker))).alias("__m")).where("__m").select(page)
    return words.join(marked, page, "left_semi")


def reuse(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at the path if it is there, else what ``make`` gives, written there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where.suffix("/_SUCCESS")):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
