"""python -m quireflow [--config FILE] [--max-images N] [--image-path DIR] [--gazetteer FILE] [--serve-deployment]"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from quireflow.config import env_file, load_settings
from quireflow.flow import run, serve


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quireflow", description="Extracts regions, texts, tags and links from a folder of images.")
    parser.add_argument("--config", help="a JSON or YAML file of settings")
    parser.add_argument("--env-file", help="a file of NAME=value lines, read as environment variables")
    parser.add_argument("--max-images", type=int, help="how many files of the folder are looked at, by name; 0: all")
    parser.add_argument("--image-path", help="the folder of images")
    parser.add_argument("--output-path", help="the folder for page files and metrics")
    parser.add_argument("--gazetteer", help="a Parquet table of name, rank and geoname_id")
    parser.add_argument("--development", action="store_true", help="the small profile, with evaluation and debug outputs")
    parser.add_argument("--serve-deployment", action="store_true", help="wait for new images until stopped")
    parser.add_argument("--checkpoint", help="a shared folder for the state of --serve-deployment")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    logging.basicConfig(level=logging.INFO)
    settings = load_settings(args.config, env_file(args.env_file) if args.env_file else None)
    if args.development:
        settings = settings.development()
    settings = settings.updated({k: v for k, v in (("max_images", args.max_images), ("image_path", args.image_path), ("output_path", args.output_path)) if v is not None})
    if args.serve_deployment and not args.checkpoint:
        raise SystemExit("--serve-deployment needs --checkpoint")
    spark = SparkSession.builder.appName("quireflow").getOrCreate()
    gazetteer = spark.read.parquet(args.gazetteer) if args.gazetteer else spark.createDataFrame([], "name string, rank int, geoname_id bigint")
    if args.serve_deployment:
        serve(spark, settings, gazetteer, args.checkpoint).awaitTermination()
    else:
        run(spark, settings, gazetteer)


if __name__ == "__main__":
    main()
