"""Page-layout XML as nested rows, with the built-in XML source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.functions.geometry import parse_coords
from quireflow.functions.text import attribute_value, custom_attributes, region_text, stem, unix_newlines
from quireflow.operators.evaluation import line_offsets

_EQUIV = "ARRAY<STRUCT<Unicode:STRING>>"
#: Only what is read is declared, so nothing else is parsed into rows.
SCHEMA = f"""_imageFilename STRING, _imageWidth STRING, _imageHeight STRING, TextRegion ARRAY<STRUCT<_id:STRING, _orientation:STRING,
  Coords:ARRAY<STRUCT<_points:STRING>>, TextEquiv:{_EQUIV}, TextLine:ARRAY<STRUCT<_id:STRING, _custom:STRING,
  Coords:ARRAY<STRUCT<_points:STRING>>, Baseline:ARRAY<STRUCT<_points:STRING>>, TextEquiv:{_EQUIV}>>>>"""


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(image_name, image_filename, width, height, regions) of every file; image_name is the file's stem."""
    raw = spark.read.format("xml").options(rowTag="Page", ignoreSurroundingSpaces="false", recursiveFileLookup="true").schema(SCHEMA).load(path)
    return raw.select(
        stem(F.col("_metadata.file_name")).alias("image_name"), F.col("_imageFilename").alias("image_filename"), F.col("_imageWidth").cast("int").alias("width"), F.col("_imageHeight").cast("int").alias("height"), F.col("TextRegion").alias("regions")
    )


def page_regions(pages: DataFrame) -> DataFrame:
    """A row per region: its own last text, else the last that any of its lines has; '' without any; null where the element is empty."""
    r = pages.select("image_name", F.posexplode("regions").alias("region_idx", "r"))
    none = F.array().cast(_EQUIV)
    of_lines = F.flatten(F.transform("r.TextLine", lambda x: F.coalesce(x["TextEquiv"], none)))
    own, below = F.coalesce("r.TextEquiv", none), F.coalesce(of_lines, none)
    # a region's own texts stand behind its lines
    text = F.when(F.size(own) > 0, F.try_element_at(own, F.lit(-1))["Unicode"]).when(F.size(below) > 0, F.try_element_at(below, F.lit(-1))["Unicode"]).otherwise(F.lit(""))
    lines = F.transform("r.TextLine", lambda x: F.coalesce(F.try_element_at(x["TextEquiv"], F.lit(-1))["Unicode"], F.lit("")))
    points = F.try_element_at("r.Coords", F.lit(1))["_points"]
    return r.select(
        "image_name", "region_idx", F.col("r._id").alias("region_id"), F.col("r._orientation").alias("orientation"), points.alias("coords"), parse_coords(points).alias("polygon"), text.alias("text"),
        region_text(text, F.coalesce(lines, F.array().cast("array<string>"))).alias("reading"),
    )


def page_lines(pages: DataFrame) -> DataFrame:
    """A row per line with its parsed attributes; a line without any has an empty array."""
    r = pages.select("image_name", F.posexplode("regions").alias("region_idx", "r")).select("image_name", "region_idx", F.posexplode("r.TextLine").alias("line_idx", "x"))
    text = F.coalesce(F.try_element_at("x.TextEquiv", F.lit(-1))["Unicode"], F.lit(""))
    return r.select(
        "image_name", "region_idx", "line_idx", F.col("x._id").alias("line_id"), F.try_element_at("x.Coords", F.lit(1))["_points"].alias("coords"),
        F.try_element_at("x.Baseline", F.lit(1))["_points"].alias("baseline"), unix_newlines(text).alias("text"), custom_attributes(F.col("x._custom")).alias("attrs"),
    )


def page_tags(lines: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Ground-truth tags placed in the region's text, whose lines are joined by an empty line."""
    placed = line_offsets(lines, ["image_name", "region_idx"], "line_idx", "text").withColumnRenamed("start", "line_start")
    tags = placed.select("image_name", "region_idx", "line_start", F.col("text").alias("line"), F.explode(F.filter("attrs", lambda a: a["tag"].isin(*labels))).alias("a"))
    offset, length = (attribute_value(F.col("a.body"), k).cast("int") for k in ("offset", "length"))
    start = F.col("line_start") + offset
    return tags.select(
        "image_name", "region_idx", F.col("a.tag").alias("label"), start.alias("start"), (start + length).alias("end"), F.substring(F.col("line"), offset + 1, length).alias("text"), attribute_value(F.col("a.body"), "Geonames").cast("bigint").alias("geoname_id"),
    )
