"""Download manifest: which document files are expected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def url_manifest(df: DataFrame, url_col: str = "pre_signed_urls") -> DataFrame:
    """``url, patient_id, file_name`` from URLs ``/a/b/<patient>/<file>``.

    A shorter path gives NULL for what it lacks.
    """
    # parse_url raises on text that is no URL under ANSI; its tolerant form
    # gives NULL.
    segments = F.split(F.try_parse_url(F.col(url_col), F.lit("PATH")), "/")
    return df.select(
        F.col(url_col).alias("url"),
        F.get(segments, F.lit(3)).alias("patient_id"),
        F.get(segments, F.lit(4)).alias("file_name"),
    )
