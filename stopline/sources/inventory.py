"""What files a dataset consists of."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.functions.paths import base_name, size_label
from stopline.schemas import FEED_DATE


def records_per_file(rows: DataFrame) -> DataFrame:
    """``(uri, n_records)`` of a file-based scan; on Parquet only the footers are read."""
    return rows.groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count("*").alias("n_records"))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset, feed_date, path, file_name, length, size_label, n_records)`` of every file under ``root``.

    The dataset is the first directory below ``root``. Names and lengths come from a listing (file contents are not read for
    it). Records are those of Parquet files, 0 for an empty one; other files have NULL. ``feed_date`` is NULL for files
    outside a day's directory.
    """
    listing = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True)
        .load(root)
        .select("path", "length", F.col("_metadata.file_path").alias("uri"))
    )
    # Tables of all kinds are counted together. No column is read, so any schema does; naming one spares looking for it.
    counted = records_per_file(
        spark.read.schema("unread INT").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").parquet(root)
    )
    below = re.escape(re.sub(r"^\w[\w+.-]*:(//[^/]*)?", "", root).rstrip("/"))
    day = F.regexp_extract("path", f"/{FEED_DATE}=([^/]*)/", 1)
    return listing.join(counted, "uri", "left").select(
        F.nullif(F.regexp_extract("path", f"{below}/([^/]+)/", 1), F.lit("")).alias("dataset"),
        F.try_to_date(F.nullif(day, F.lit("")), "yyyy-MM-dd").alias(FEED_DATE),
        "path",
        base_name(F.col("path")).alias("file_name"),
        "length",
        size_label(F.col("length")).alias("size_label"),
        F.when(F.endswith("path", F.lit(".parquet")), F.coalesce("n_records", F.lit(0))).alias("n_records"),
    )


def dataset_totals(inventory: DataFrame) -> DataFrame:
    """``(dataset, n_files, n_bytes, size_label, n_records)`` from the output of :func:`file_inventory`."""
    totals = inventory.groupBy("dataset").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.sum("n_records").alias("n_records")
    )
    return totals.withColumn("size_label", size_label(F.col("n_bytes")))
