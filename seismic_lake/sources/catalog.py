"""The fixed-width hypocenter catalog: zip files of 96-byte lines."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import count, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismic_lake.functions.fixed_width import code_label, coded_magnitude, degrees_minutes, implied_decimal
from seismic_lake.functions.text import clean_text
from seismic_lake.functions.times import fixed_offset_local
from seismic_lake.vocab import EVENT_CLASS_CODES, EVENT_CLASS_DEFAULT, INTENSITY_CODES, MAG_TYPE_CODES

LINES_PER_BATCH = 50_000
MIN_LINE_LENGTH = 68  # fixed value: shorter lines are not hypocenter records


def _zip_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # latin-1 maps every byte to one character, so byte columns stay character columns.
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.infolist():
                    if member.is_dir():
                        continue
                    with archive.open(member) as stream:
                        numbers = count(1)
                        while chunk := list(islice(stream, LINES_PER_BATCH)):
                            lines = [raw.rstrip(b"\r\n").decode("latin-1") for raw in chunk]
                            yield pd.DataFrame(
                                {
                                    "file": path,
                                    "member": member.filename,
                                    "line_no": list(islice(numbers, len(lines))),
                                    "line": lines,
                                }
                            )


def list_catalog_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, size, last_modified) of every zip; only the listing is read, not the contents."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "h*.zip")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def read_catalog_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every member of every zip. Files are spread over tasks by size.

    A zip is unpacked by one task, a block of lines at a time; the lines are dealt out again before the
    costlier parsing, and AQE merges or splits the partitions.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "h*.zip")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    lines = files.select("path", "content").mapInPandas(
        _zip_lines, "file string, member string, line_no bigint, line string"
    )
    return lines.hint("rebalance")


def parse_catalog(lines: DataFrame) -> DataFrame:
    """Typed hypocenters from a ``line`` column, all with status 'final'."""
    line = F.col("line")

    def char(position: int):
        return F.substring(line, position, 1)

    def whole(start: int, width: int):
        return F.substring(line, start, width).try_cast("int")

    parts = lines.where(F.length(line) >= MIN_LINE_LENGTH).select(
        line,
        F.coalesce(implied_decimal(line, 14, 4, 2), F.lit(0.0)).alias("sec"),
        implied_decimal(line, 22, 3).alias("lat_deg"),
        implied_decimal(line, 25, 4, 2).alias("lat_min"),
        implied_decimal(line, 33, 4).alias("lon_deg"),
        implied_decimal(line, 37, 4, 2).alias("lon_min"),
        implied_decimal(line, 45, 5, 2).alias("depth_km"),
        coded_magnitude(line, 53).alias("mag_first"),
        coded_magnitude(line, 56).alias("mag_second"),
    )
    type_code = F.when(F.col("mag_first").isNotNull(), char(55)).otherwise(char(58))
    return parts.select(
        fixed_offset_local(
            whole(2, 4), whole(6, 2), whole(8, 2), whole(10, 2), whole(12, 2), F.col("sec")
        ).alias("event_time"),
        degrees_minutes(F.col("lat_deg"), F.col("lat_min")).alias("latitude"),
        degrees_minutes(F.col("lon_deg"), F.col("lon_min")).alias("longitude"),
        "depth_km",
        F.coalesce("mag_first", "mag_second").alias("mag"),
        code_label(type_code, MAG_TYPE_CODES).alias("mag_type"),
        code_label(char(62), INTENSITY_CODES).alias("max_intensity"),
        code_label(char(61), EVENT_CLASS_CODES, EVENT_CLASS_DEFAULT).alias("event_type"),
        clean_text(F.substring(line, 69, 24)).alias("region"),
        char(1).alias("agency"),
        F.lit("final").alias("status"),
        F.lit("jma_catalog").alias("source"),
    )
