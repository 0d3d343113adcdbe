"""Table roles: the driver's tables read as images, regions, readings, gazetteer and metric events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only on a single machine whose session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    return "file:///tmp/checkpoints"


def regions(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Order lines as regions of an image (the order), numbered from 0, with integer boxes; also: further columns."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem")
    box = F.struct((F.col("l_linenumber") * 10).alias("x"), (F.col("l_partkey") % 50).cast("int").alias("y"), F.col("l_quantity").cast("int").alias("w"), (F.col("l_suppkey") % 30 + 5).cast("int").alias("h"))
    # numbered first: a box is made of the columns that are shuffled for it, and not shuffled itself
    numbered = lines.withColumn("region_idx", F.row_number().over(order) - 1)
    return numbered.select(F.col("l_orderkey").alias("image_name"), "region_idx", box.alias("box"), "l_returnflag", "l_linestatus", *also)


REGIONS_SQL = """regions AS (
  SELECT l_orderkey AS image_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS region_idx,
         l_linenumber * 10 AS x, (l_partkey % 50)::INT AS y, trunc(l_quantity)::INT AS w, (l_suppkey % 30 + 5)::INT AS h, l_returnflag, l_linestatus
  FROM lineitem)"""
