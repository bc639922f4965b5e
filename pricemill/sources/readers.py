"""Scans with declared schemas."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import domain, schemas
from ..functions.values import constant_frame


def read_mapping(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Commodity names from a CSV file, or the built-in mapping."""
    if path is None:
        return constant_frame(
            spark, domain.COMMODITY_MAPPING, [f.split()[0] for f in schemas.COMMODITY_MAPPING.split(", ")]
        )
    return spark.read.schema(schemas.COMMODITY_MAPPING).option("header", True).csv(path)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(place, record) of the CSV records of a file, numbered from 0: a record goes on to the next line while a
    quotation mark is open, wherever the file's blocks are cut.

    Whether a line begins inside a quoted cell depends on the number of marks before it. Marks are counted per block
    first, of which there are few; then each block numbers its own lines.
    """
    marks = F.char_length("value") - F.char_length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        marks.alias("marks"),
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("block").orderBy("line")
    # One row per block of the file.
    blocks = lines.groupBy("block").agg(F.sum("marks").alias("_marks"))
    opened = blocks.select("block", F.coalesce(F.sum("_marks").over(earlier), F.lit(0)).alias("_marks"))
    before = F.coalesce(F.sum("marks").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_marks")
    begun = lines.join(opened, "block").withColumn("begins", (before % 2 == 0).cast("long"))
    counts = begun.groupBy("block").agg(F.sum("begins").alias("_begun"))
    offsets = counts.select("block", F.coalesce(F.sum("_begun").over(earlier), F.lit(0)).alias("_begun"))
    place = F.sum("begins").over(in_block) + F.col("_begun") - 1
    placed = begun.join(offsets, "block").select(place.alias("place"), "block", "line", "value")
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    return placed.groupBy("place").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record"))


def read_monthly_sheet(spark: SparkSession, path: str, skip_rows: int = 4) -> DataFrame:
    """Wide monthly sheet saved as CSV, with the header after ``skip_rows`` rows and blanks around names.

    A cell in quotation marks may hold line breaks. The first rows are told by their place in the file, so a later row
    that repeats one of them stays. Only the header reaches the driver, for the names. All cells stay text: the
    cleaning step casts them, and reads a row without a period, such as a row of units, as undated.
    """
    records = csv_records(spark, path)
    head = records.filter(F.col("place") == skip_rows).first()
    names = [" ".join(c.split()) or f"Unnamed: {i}" for i, c in enumerate(next(csv.reader(io.StringIO(head.record, newline=""))))]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    body = records.filter((F.col("place") > skip_rows) & (F.trim("record") != ""))
    return body.select(F.from_csv("record", schema, {"multiLine": "true", "escape": '"'}).alias("cells")).select("cells.*").toDF(*names)


def read_quotes(spark: SparkSession, landing: str) -> DataFrame:
    """Landed quote snapshots, as JSON lines."""
    return spark.read.schema(schemas.QUOTES).json(landing)


def stream_quotes(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """The same files as a stream."""
    reader = spark.readStream.schema(schemas.QUOTES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing)


def read_forecast_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FORECAST).option("header", True).csv(path)
