"""Optional outputs for looking at a run: pictures of its steps and a table of samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.functions.geometry import normalized_box
from quireflow.functions.text import stem
from quireflow.operators.images import crop, draw_rectangle, encode_png
from quireflow.sources.page_sink import write_files

_FILES = "name string, content binary"


def _image(r: object) -> np.ndarray:
    image = np.frombuffer(r.data, np.uint8)
    return image.reshape(r.height, r.width) if r.n_channels == 1 else image.reshape(r.height, r.width, r.n_channels)


def _named(name: str) -> str:
    return name.rsplit(".", 1)[0]


def image_files(images: DataFrame) -> DataFrame:
    """(name, content) of images as <stem>.png; pictures are written without loss, as no encoder for .jpg is at hand."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(f"{_named(r.image_name)}.png", encode_png(_image(r))) for r in f.itertuples(index=False)], columns=["name", "content"])

    return images.select("image_name", "width", "height", "n_channels", "data").mapInPandas(run, _FILES)


def crop_files(images: DataFrame) -> DataFrame:
    """(name, content) of each mask's box cut from its image, <stem>_<number from 1>.png."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                for i, m in enumerate(r.masks, 1):
                    part = crop(_image(r), m["box"]["x"], m["box"]["y"], m["box"]["w"], m["box"]["h"])
                    rows.append((f"{_named(r.image_name)}_{i}.png", encode_png(part)))
            yield pd.DataFrame(rows, columns=["name", "content"])

    return images.select("image_name", "width", "height", "n_channels", "data", "masks").mapInPandas(run, _FILES)


def mask_files(images: DataFrame) -> DataFrame:
    """(name, content) of each mask with its box drawn, masks/<stem>_mask<number from 0>.png."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                for i, m in enumerate(r.masks):
                    mask = np.unpackbits(np.frombuffer(m["pixels"], np.uint8), count=r.height * r.width).reshape(r.height, r.width)
                    drawn = draw_rectangle(mask * np.uint8(100), m["box"]["x"], m["box"]["y"], m["box"]["w"], m["box"]["h"])
                    rows.append((f"masks/{_named(r.image_name)}_mask{i}.png", encode_png(drawn)))
            yield pd.DataFrame(rows, columns=["name", "content"])

    return images.select("image_name", "width", "height", "masks").mapInPandas(run, _FILES)


def samples(images: DataFrame, folder: str, tag: str, suffix: str | None = None) -> DataFrame:
    """(filepath, tags, image_name, predictions) of images; predictions are the masks' boxes as shares of the image, none without masks.

    suffix: that of the file in the folder, if it is not the image's own.
    """
    name = F.col("image_name") if suffix is None else F.concat(stem(F.col("image_name")), F.lit(suffix))
    kind = "array<struct<label:string,bounding_box:struct<x:double,y:double,w:double,h:double>>>"
    found = F.array().cast(kind)
    if "masks" in images.columns:
        found = F.transform("masks", lambda m: F.struct(F.lit("predicted_object").alias("label"), normalized_box(m["box"], F.col("width"), F.col("height")).alias("bounding_box")))
    return images.select(F.concat(F.lit(folder.rstrip("/") + "/"), name).alias("filepath"), F.array(F.lit(tag)).alias("tags"), "image_name", found.cast(kind).alias("predictions"))


def write_debug(preprocessed: DataFrame, segmented: DataFrame, image_path: str, folder: str, run_id: str) -> None:
    """All debug outputs of a run below <folder>/<module>/<run_id>, and its samples added to <folder>/samples."""
    if not folder:
        raise ValueError("debug outputs need a folder")
    seen = f"{folder.rstrip('/')}/preprocessing/{run_id}"
    write_files(image_files(preprocessed), seen)
    write_files(crop_files(segmented).unionByName(mask_files(segmented)), f"{folder.rstrip('/')}/layout_analysis/{run_id}")
    rows = samples(preprocessed, image_path, "original").unionByName(samples(preprocessed, seen, "preprocessed", ".png")).unionByName(samples(segmented, image_path, "layout_analysis"))
    rows.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(f"{folder.rstrip('/')}/samples")
