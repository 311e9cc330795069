"""File sinks and dataset sources.

Outputs are written by the executors in parallel (one file per task);
nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.operators.splits import percent_slice

# --- fixed values (must equal the reference's) ---
EXTRACT_HEADER = ("Page ID", "Page Title", "Categories", "Page Text")
FETCH_ERROR = "Failed to retrieve the webpage"
# --- end of fixed values ---
EXTRACT_SCHEMA = T.StructType([
    T.StructField("Page ID", T.LongType()),
    T.StructField("Page Title", T.StringType()),
    T.StructField("Categories", T.StringType()),
    T.StructField("Page Text", T.StringType()),
])


def write_extract_csv(extracted: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: CSV with the four named columns; categories comma-joined."""
    rows = extracted.select(
        F.col("page_id").alias(EXTRACT_HEADER[0]),
        F.col("title").alias(EXTRACT_HEADER[1]),
        F.array_join("categories", ",").alias(EXTRACT_HEADER[2]),
        F.col("text").alias(EXTRACT_HEADER[3]),
    )
    rows.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_extract_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read an A4 file back (text may hold newlines, hence multiLine)."""
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .schema(EXTRACT_SCHEMA).csv(path)
    )


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: the curated dataset, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_dataset(spark: SparkSession, path: str, split: str, percent: float | None = None,
                 key: str = "page_id") -> DataFrame:
    """One split (partition-pruned), optionally its first ``percent`` %."""
    df = spark.read.parquet(path).where(F.col("split") == F.lit(split))
    if percent is not None:
        df = percent_slice(df, key, percent)
    return df


def read_html_pages(df: DataFrame, status: str | None = "status") -> tuple[DataFrame, DataFrame]:
    """Fetched pages -> (ok pages, error rows).

    The reference fetches one URL over HTTP; here pages arrive as a table
    ``(page_id, url, html[, status])``.  Rows whose status is not 200 go
    to the error output instead of flowing on as a string."""
    if status is None or status not in df.columns:
        return df, df.limit(0).withColumn("error", F.lit(None).cast("string"))
    ok = df.where(F.col(status) == 200)
    bad = df.where((F.col(status) != 200) | F.col(status).isNull()).withColumn(
        "error", F.lit(FETCH_ERROR)
    )
    return ok, bad
