"""Image listing, decoding and ground-truth pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireflow.config import IMAGE_NAME
from quireflow.functions.text import stem
from quireflow.sources.scratch import Scratch


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """(image_name, path) of every file in a folder, not below it; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("image_name"), "path")


def first_images(names: DataFrame, most: int, name: str = "image_name") -> DataFrame:
    """The first `most` files by name (all, if not positive), then only images; image_index counts every file.

    With a limit only that many rows are ranked. Without one the listing is sorted by range, numbered inside each range,
    and each range is lifted by the number of files in those before it.
    """
    if most > 0:
        ranked = names.orderBy(name).limit(most).withColumn("image_index", F.row_number().over(Window.orderBy(name)) - 1)
        return ranked.where(F.lower(name).rlike(IMAGE_NAME))
    # written, so that both uses see the same ranges
    ordered = Scratch(names.orderBy(name).withColumn("_place", F.monotonically_increasing_id()), "listing").df
    numbered = ordered.select("*", F.shiftright("_place", 33).alias("_range"), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_in"))
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = counts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = numbered.join(F.broadcast(before), "_range").withColumn("image_index", (F.col("_in") + F.col("_before")).cast("int"))
    return ranked.drop("_place", "_range", "_in", "_before").where(F.lower(name).rlike(IMAGE_NAME))


def nth_file(names: DataFrame, n: int, name: str = "image_name", suffixes: tuple[str, ...] = ("png", "jpg", "jpeg")) -> DataFrame:
    """The n-th file by name, from 0, of those with one of the suffixes (case counts)."""
    return names.where(F.col(name).rlike(rf"\.({'|'.join(suffixes)})$")).orderBy(name).offset(n).limit(1)


#: Patterns of the names that images have.
NAMES = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG],[tT][iI][fF],[tT][iI][fF][fF]}"


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(image_name, width, height, n_channels, data) of the images in a folder, not below it, or of these files only.

    A file that cannot be read or decoded has no row; unread() names it.
    """
    kind = spark.read.format("image").options(dropInvalid="true", ignoreCorruptFiles="true", ignoreMissingFiles="true")
    if isinstance(path, list):
        raw = kind.load(path) if path else spark.createDataFrame([], "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    else:
        raw = kind.option("pathGlobFilter", NAMES).load(path)
    return decoded(raw)


def decoded(images: DataFrame) -> DataFrame:
    """(image_name, width, height, n_channels, data) of rows of Spark's image source."""
    return images.select(F.element_at(F.split("image.origin", "/"), -1).alias("image_name"), "image.width", "image.height", F.col("image.nChannels").alias("n_channels"), "image.data")


def image_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One image of a folder by its name; no row if it is not there."""
    return read_images(spark, [f"{folder.rstrip('/')}/{name}"])


def unread(names: DataFrame, images: DataFrame) -> DataFrame:
    """(image_name, error) of listed images that gave no pixels."""
    return names.select("image_name").join(images.select("image_name"), "image_name", "left_anti").withColumn("error", F.lit("cannot be read as an image"))


def with_truth(images: DataFrame, pages: DataFrame) -> DataFrame:
    """Images with their ground truth by stem; null where there is none."""
    keyed = images.withColumn("_stem", stem(F.col("image_name")))
    truth = pages.withColumnRenamed("image_name", "_stem")
    return keyed.join(truth, "_stem", "left").drop("_stem")


def without_truth(images: DataFrame, pages: DataFrame) -> DataFrame:
    """Names of images that have no ground truth, for a warning."""
    return images.select("image_name", stem(F.col("image_name")).alias("_stem")).join(pages.select(F.col("image_name").alias("_stem")), "_stem", "left_anti").select("image_name")
