"""The extraction flow: images to regions, readings, tags, links and page files, with evaluation beside it.

Every stage is a function from DataFrame to DataFrame. Pixels stay in an image's row, so only texts, spans, links and
words of masks are shuffled. An image that cannot be read or fails is left out and named with its error; the others go on. How many rows a
stage had, and how many failed, is observed in the pass that writes it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quireflow.config import Settings, logger
from quireflow.functions.text import run_stamp
from quireflow.operators.evaluation import assigned_errors, link_scores, prepared_truth, region_tag_scores
from quireflow.operators.images import kept_masks, preprocess, read_boxes, segment_images
from quireflow.operators.linking import link_spans
from quireflow.operators.raster import polygon_scores
from quireflow.operators.tagging import rules, with_tags
from quireflow.sources.debug_sink import write_debug
from quireflow.sources.image_source import image_folder
from quireflow.sources.images import NAMES, decoded, read_images, unread, with_truth, without_truth
from quireflow.sources.metric_sink import MetricSink
from quireflow.sources.page_sink import page_xml, recognition_json, region_rows, write_pages, write_recognition
from quireflow.sources.page_xml import page_lines, page_regions, read_pages
from quireflow.sources.scratch import Scratch


@dataclass
class Extraction:
    """What a flow finds, as DataFrames; nothing is computed before one of them is used."""

    images: DataFrame  # image_name, width, height, n_channels of the files read
    preprocessed: DataFrame
    segmented: DataFrame  # with masks, filtered and numbered by place
    readings: DataFrame  # image_name, region_idx, box, text, width, height
    tags: DataFrame  # image_name, region_idx, label, start, end, text
    links: DataFrame  # image_name, region_idx, link_idx, text, label, geoname_ids
    pages: DataFrame  # image_name, xml
    errors: DataFrame  # image_name, stage, error


def tagged(texts: DataFrame, settings: Settings) -> DataFrame:
    """(image_name, region_idx, label, start, end, text) of texts (image_name, region_idx, text)."""
    found = with_tags(texts, labels=settings.labels(settings.rule_labels), table=rules(settings.uri_host, settings.label_prefix))
    return found.select("image_name", "region_idx", F.explode("tags").alias("s")).select("image_name", "region_idx", "s.*")


def linked(spans: DataFrame, gazetteer: DataFrame, settings: Settings) -> DataFrame:
    """(image_name, region_idx, link_idx, text, label, geoname_ids) of place-name spans; links are numbered as their spans stand in the text."""
    found = link_spans(spans, gazetteer, settings.labels(settings.geo_labels))
    numbered = found.groupBy("image_name", "region_idx").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", "text", "geoname_ids"))).alias("l"))
    return numbered.select("image_name", "region_idx", F.posexplode("l").alias("link_idx", "x")).select("image_name", "region_idx", "link_idx", "x.text", "x.label", "x.geoname_ids")


def extract(images: DataFrame, gazetteer: DataFrame, settings: Settings, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Extraction:
    """The per-image flow over decoded images (image_name, width, height, n_channels, data).

    keep: stores the result of a stage that is dear and used more than once, and gives it back.
    """
    seen = keep(preprocess(images, settings.steps, settings.max_image_dimension), "preprocessed")
    good = seen.where("error IS NULL").drop("error")
    found = keep(segment_images(good, settings.segmenter, settings.least_mask_pixels, settings.closing_kernel), "segmented")
    kept = kept_masks(F.col("masks"), F.col("width"), F.col("height"), settings.least_area_share, settings.least_fill)
    segmented = found.where("error IS NULL").withColumn("masks", kept)
    read = keep(read_boxes(segmented.withColumn("boxes", F.transform("masks", lambda m: m["box"])), settings.backend, settings.prompt), "read")
    readings = read.select("image_name", "width", "height", F.explode("readings").alias("r")).select("image_name", "r.region_idx", "r.box", "r.text", "width", "height")
    tags = tagged(readings.select("image_name", "region_idx", "text"), settings)
    links = linked(tags, gazetteer, settings)
    # pages speak of the file's size, boxes of the resized image, as they were found
    sizes = images.select("image_name", "width", "height")
    regions = region_rows(readings.drop("width", "height").join(sizes, "image_name"), tags, links)
    failed = [of.where("error IS NOT NULL").select("image_name", F.lit(stage).alias("stage"), "error") for stage, of in (("preprocessing", seen), ("layout", found), ("recognition", read))]
    errors = failed[0].unionByName(failed[1]).unionByName(failed[2])
    whole = sizes.join(errors.select("image_name"), "image_name", "left_anti")
    return Extraction(images.drop("data"), good, segmented, readings, tags, links, page_xml(regions, settings.creator, images=whole), errors)


def evaluate(found: Extraction, truth: DataFrame, gazetteer: DataFrame, settings: Settings, gate: Observation | None = None) -> dict[str, DataFrame]:
    """Scores of each module against page truth (read_pages), for images that have one, by the module's name.

    Layout is held against the true polygons and readings against the true texts (gate counts the images whose numbers
    of texts differ, as the text scores are computed). Tags and links are found anew in the true texts and spans, so a
    module is not judged by what stands before it; they are held against an image's first true region with a text, tagged or not.
    """
    images = found.images.select("image_name", "width", "height")
    with_page = with_truth(images, truth.select("image_name", "regions")).where("regions IS NOT NULL")
    pages = with_page.select("image_name", "regions", "width", "height")
    regions = page_regions(pages)
    polygons = regions.groupBy("image_name").agg(F.array_sort(F.collect_list(F.struct("region_idx", "polygon"))).alias("p")).select("image_name", F.transform("p", lambda x: x["polygon"]).alias("polygons"))
    layout = polygon_scores(found.segmented, pages.select("image_name", F.col("width").alias("true_width"), F.col("height").alias("true_height")).join(polygons, "image_name"))
    read = found.readings.join(with_page.select("image_name"), "image_name", "left_semi").select("image_name", F.col("region_idx").alias("idx"), F.lit("pred").alias("side"), "text")
    wanted = regions.select("image_name", F.col("region_idx").alias("idx"), F.lit("gt").alias("side"), F.col("reading").alias("text"))
    texts, spans = prepared_truth(page_lines(pages), settings.labels(settings.tag_labels))
    again = with_tags(texts, labels=settings.labels(settings.rule_labels), table=rules(settings.uri_host, settings.label_prefix))
    own_tags = again.select("image_name", "region_idx", F.explode_outer("tags").alias("s")).select("image_name", "region_idx", "s.label", "s.start", "s.end")
    first = texts.groupBy("image_name").agg(F.min("region_idx").alias("region_idx"))
    true_spans = spans.join(first, ["image_name", "region_idx"])
    geo = settings.labels(settings.geo_labels)
    return {
        "layout": layout,
        "text": assigned_errors(wanted.unionByName(read), "image_name", gate),
        "tags": region_tag_scores(spans, own_tags, texts),
        "links": link_scores(true_spans, link_spans(true_spans.drop("geoname_id"), gazetteer, geo), labels=geo, images=first),
    }


def run(spark: SparkSession, settings: Settings, gazetteer: DataFrame, run_id: str | None = None) -> dict:
    """Reads a folder of images and writes a page file per image, and metrics and debug outputs if asked for.

    Returns the run's id and what was counted on the way, by stage: rows, and of those failed. Stages are written below work/<run id> of the
    output, so files are decoded and models run once. Files are listed and cut to the limit before any is opened. A new
    run begins its metric tables anew.
    """
    run_id = run_id or spark.range(1).select(run_stamp(F.current_timestamp())).first()[0]
    log = logger("flow", run_id)
    out = settings.output_path.rstrip("/")
    counts: dict[str, dict] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        watch = Observation(name)
        failed = F.count("error") if "error" in df.columns else F.count(F.lit(None))
        df.observe(watch, F.count(F.lit(1)).alias("rows"), failed.alias("failed")).write.mode("overwrite").parquet(f"{out}/work/{run_id}/{name}")
        counts[name] = watch.get
        return spark.read.schema(df.schema).parquet(f"{out}/work/{run_id}/{name}")

    names = keep(image_folder(spark, settings.image_path, settings.max_images), "listing")
    # a limit bounds the list of paths; without one the folder is read by pattern
    path = [r.path for r in names.select("path").collect()] if settings.max_images > 0 else settings.image_path
    images = keep(read_images(spark, path), "decoded")
    found = extract(images, gazetteer, settings, keep)
    found.errors = unread(names, images).select("image_name", F.lit("reading").alias("stage"), "error").unionByName(found.errors)
    write_pages(found.pages, settings.output_path)
    if counts["decoded"]["rows"] < counts["listing"]["rows"] or any(c["failed"] for c in counts.values()):
        for r in found.errors.limit(100).collect():
            log.error("image %s failed in %s: %s", r.image_name, r.stage, r.error)
    if settings.evaluation and settings.truth_path:
        truth, gate = read_pages(spark, settings.truth_path), Observation("gate")
        alone = keep(without_truth(found.images, truth), "without_truth")
        for r in alone.limit(100).collect() if counts["without_truth"]["rows"] else []:
            log.warning("no ground truth for image %s", r.image_name)
        sink = MetricSink(spark, f"{out}/metrics", run_id)
        sink.reset()
        sink.commit(0, evaluate(found, truth, gazetteer, settings, gate))
        counts["text"] = gate.get
        if counts["text"]["unequal"]:
            log.warning("%d images have another number of texts than their ground truth, their readings are not scored", counts["text"]["unequal"])
    if settings.debug:
        write_debug(found.preprocessed, found.segmented, settings.image_path, f"{out}/debug", run_id)
        indexed = found.readings.join(names.select("image_name", "image_index"), "image_name").drop("width", "height")
        write_recognition(recognition_json(indexed), f"{out}/debug/text_recognition/{run_id}")
    for name, c in counts.items():
        log.info("%s: %s", name, c)
    return {"run_id": run_id, "counts": counts}


def serve(spark: SparkSession, settings: Settings, gazetteer: DataFrame, checkpoint: str, once: bool = False):
    """A query that waits for image files and writes the pages of each batch of new ones; once: only of those there are.

    A batch holds the pixels of its own new files, decoded by the stream's source; files that were seen are not read again. It
    has as many files as the summary interval at most, so that many images on, at the latest, their scores are committed (run "served", once a batch).
    """
    kind = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
    files = spark.readStream.format("image").schema(kind).options(dropInvalid="true", pathGlobFilter=NAMES, maxFilesPerTrigger=settings.summary_interval).load(settings.image_path)
    sink = MetricSink(spark, f"{settings.output_path.rstrip('/')}/metrics", "served")

    def batch(new: DataFrame, number: int) -> None:
        held: list[Scratch] = []

        def keep(df: DataFrame, name: str) -> DataFrame:
            held.append(Scratch(df, name))
            return held[-1].df

        found = extract(keep(new, "decoded"), gazetteer, settings, keep)
        write_pages(found.pages, settings.output_path)
        if settings.evaluation and settings.truth_path:
            sink.commit(number, evaluate(found, read_pages(spark, settings.truth_path), gazetteer, settings))
        for table in held:
            table.drop()

    stream = decoded(files).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime="10 seconds")).start()
