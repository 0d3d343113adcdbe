"""Page-layout XML, recognition JSON and metric tables as outputs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quireflow.functions.geometry import box_to_coords
from quireflow.functions.text import stem

#: Fixed value: the format's name space.
NAMESPACE = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"


def custom_string(index: Column, spans: Column) -> Column:
    """A line's custom attribute: its reading order, then every span as 'label {offset:o; length:l;}'."""
    each = F.transform(spans, lambda s: F.format_string(" %s {offset:%d; length:%d;}", s["label"], s["start"], s["end"] - s["start"]))
    return F.concat(F.format_string("readingOrder {index:%d;}", index), F.array_join(each, ""))


def region_rows(readings: DataFrame, tags: DataFrame, links: DataFrame) -> DataFrame:
    """Regions (image_name, region_idx, box, text, width, height) with their spans and links, each in order; empty where they have none.

    tags: (image_name, region_idx, label, start, end); links: (image_name, region_idx, link_idx, text, label, geoname_ids).
    """
    key = ["image_name", "region_idx"]
    # three kinds of rows and one aggregate: nothing is moved for it if the inputs are dealt by image alike, and they share what they are made of
    parts = {
        "r": (readings, F.struct(*[c for c in readings.columns if c not in key])),
        "s": (tags, F.struct("start", "end", "label")),
        "l": (links, F.struct("link_idx", "text", "label", "geoname_ids")),
    }
    types = {name: df.select(of.alias(name)).schema[name].dataType for name, (df, of) in parts.items()}
    rows = [df.select(*key, *[(of if n == name else F.lit(None)).cast(t).alias(n) for n, t in types.items()]) for name, (df, of) in parts.items()]
    met = reduce(lambda x, y: x.union(y), rows).groupBy(*key).agg(F.collect_list("r").alias("rs"), *[F.array_sort(F.collect_list(n)).alias(n) for n in "sl"])
    # a null key equals none
    known = F.col("image_name").isNotNull() & F.col("region_idx").isNotNull()
    kept = [F.col(c).cast(readings.schema[c].dataType).alias(c) for c in key]
    met = met.select(*kept, *[F.when(known, F.col(n)).alias(n) for n in "sl"], F.explode("rs").alias("r")).select(*key, "r.*", "s", "l")
    own = F.transform(F.coalesce("s", F.array().cast("array<struct<start:int,end:int,label:string>>")), lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), x["end"].alias("end")))
    found = F.transform(F.coalesce("l", F.array().cast("array<struct<link_idx:int,text:string,label:string,geoname_ids:array<bigint>>>")), lambda x: F.struct(x["text"].alias("text"), x["label"].alias("label"), x["geoname_ids"].alias("geoname_ids")))
    return met.select(*readings.columns, own.alias("spans"), found.alias("links"))


def page_xml(regions: DataFrame, creator: str = "quireflow", at: Column | None = None, images: DataFrame | None = None) -> DataFrame:
    """(image_name, xml) of regions (image_name, region_idx, box, text, spans, width, height, and links if present).

    at: the time that a page is said to be created (now by default); images (image_name, width, height): if given,
    those without a region have a page as well.
    """
    links = F.col("links") if "links" in regions.columns else F.array().cast("array<struct<text:string,label:string,geoname_ids:array<bigint>>>")

    def region(x: Column) -> Column:
        points = F.struct(box_to_coords(*[x["box"][c] for c in "xywh"]).alias("_points"))
        equiv = F.struct(x["text"].alias("Unicode"))
        line = F.struct(custom_string(x["region_idx"], x["spans"]).alias("_custom"), F.lit("line_1").alias("_id"), points.alias("Coords"), points.alias("Baseline"), equiv.alias("TextEquiv"))
        entity = F.transform(x["links"], lambda e, i: F.struct(F.concat(F.lit("entity_linking_"), i.cast("string")).alias("_id"), e["text"].alias("_text"), e["label"].alias("_label"), F.concat(F.lit("["), F.array_join(e["geoname_ids"], ", "), F.lit("]")).alias("_geoname_ids")))
        return F.struct(F.concat(F.lit("TextRegion_"), x["region_idx"].cast("string")).alias("_id"), F.format_string("readingOrder {index:%d;}", x["region_idx"]).alias("_custom"), points.alias("Coords"), line.alias("TextLine"), equiv.alias("TextEquiv"), entity.alias("EntityLinking"))

    # what is shuffled are a region's values; their elements, several times as large, are made in the page's row
    pages = regions.groupBy("image_name", "width", "height").agg(F.array_sort(F.collect_list(F.struct("region_idx", "box", "text", "spans", links.alias("links")))).alias("rs"))
    if images is not None:
        pages = images.select("image_name", "width", "height").join(pages.select("image_name", "rs"), "image_name", "left")
    order = F.struct(F.struct(F.lit("ro_group_1").alias("_id"), F.transform("rs", lambda x: F.struct(x["region_idx"].alias("_index"), F.concat(F.lit("TextRegion_"), x["region_idx"].cast("string")).alias("_regionRef"))).alias("RegionRefIndexed")).alias("OrderedGroup"))
    now = F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    root = F.struct(
        F.lit(NAMESPACE).alias("_xmlns"),
        F.struct(F.lit(creator).alias("Creator"), now.alias("Created"), now.alias("LastChange")).alias("Metadata"),
        F.struct(F.col("image_name").cast("string").alias("_imageFilename"), F.col("width").alias("_imageWidth"), F.col("height").alias("_imageHeight"), order.alias("ReadingOrder"), F.transform("rs", region).alias("TextRegion")).alias("Page"),
    )
    return pages.select("image_name", F.to_xml(root, {"rowTag": "PcGts"}).alias("xml"))


#: Fixed value: what a page file begins with.
XML_HEADER = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def write_files(files: DataFrame, folder: str) -> None:
    """A file per row (name, content: string or binary) in a folder that all machines share.

    Written under a name of its own and then moved, so a repeated or lost task leaves whole files only. Of several rows
    with one name, one file stays.
    """

    def write(rows: Iterator[Row]) -> None:
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}")
        for r in rows:
            path, part = f"{base}/{r.name}", f"{base}/.{r.name.replace('/', '_')}.{uuid.uuid4().hex}"
            fs.create_dir(os.path.dirname(path), recursive=True)
            with fs.open_output_stream(part) as out:
                out.write(r.content.encode() if isinstance(r.content, str) else bytes(r.content))
            fs.move(part, path)

    files.select("name", "content").foreachPartition(write)


def write_pages(pages: DataFrame, folder: str) -> None:
    """<stem>.xml for each page (image_name, xml), with the header before it."""
    write_files(pages.select(F.concat(stem(F.col("image_name")), F.lit(".xml")).alias("name"), F.concat(F.lit(XML_HEADER), F.col("xml"), F.lit("\n")).alias("content")), folder)


def write_recognition(readings: DataFrame, folder: str) -> None:
    """<name up to its first point>.json for each image of recognition_json."""
    write_files(readings.select(F.concat(F.substring_index("image_name", ".", 1), F.lit(".json")).alias("name"), F.col("json").alias("content")), folder)


def recognition_json(regions: DataFrame) -> DataFrame:
    """(image_name, json): image_index and the regions' boxes and texts, in order."""
    one = F.struct(F.array(*[F.col(f"box.{c}") for c in "xywh"]).alias("bbox"), F.col("text"))
    rows = regions.groupBy("image_name", "image_index").agg(F.array_sort(F.collect_list(F.struct("region_idx", one.alias("r")))).alias("rs"))
    return rows.select("image_name", F.to_json(F.struct("image_index", F.transform("rs", lambda x: x["r"]).alias("regions"))).alias("json"))


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Adds a run's rows to a metric table, partitioned by run."""
    metrics.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def reset_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Puts a run's rows in the place of all that it wrote before; other runs stay."""
    metrics.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
