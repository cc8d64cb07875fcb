"""Landed API pages: ``{"total_count": n, "results": [{…}, …]}``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TORN = "_corrupt_record"


def _envelopes(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    # Records stay JSON text, so fields no schema names are not lost on the way.
    envelope = f"total_count BIGINT, results ARRAY<STRING>, {_TORN} STRING"
    reader = spark.read.schema(envelope).option("columnNameOfCorruptRecord", _TORN)
    pages = reader.json(path, multiLine=multi_line)
    return pages.select("total_count", "results", _TORN, F.input_file_name().alias("file"))


def read_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row ``json_str`` per record of all readable pages under ``path``.

    ``multi_line=False`` is for pages landed one per line: such files can be
    split, and one file may hold any number of pages.  Pages that can't be read
    are listed by :func:`unreadable_pages` and make a pull incomplete.
    """
    pages = _envelopes(spark, path, multi_line)
    return pages.where(f"{_TORN} IS NULL").select(F.explode("results").alias("json_str"))


def unreadable_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``file, page`` of every page under ``path`` that is torn or no page at all."""
    pages = _envelopes(spark, path, multi_line)
    bad = F.col(_TORN).isNotNull() | F.col("results").isNull()
    return pages.where(bad).select("file", F.col(_TORN).alias("page"))


def declared_totals(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Per pull (directory): ``expected`` records as its pages declare, ``landed`` different records, ``torn`` pages.

    Copies of a record count once, so two copies of half a pull aren't a whole one.
    """
    pages = _envelopes(spark, path, multi_line).withColumn(
        "pull", F.regexp_replace("file", "/[^/]*$", "")
    )
    bad = F.col(_TORN).isNotNull() | F.col("results").isNull()
    totals = pages.groupBy("pull").agg(
        F.max("total_count").alias("expected"),
        F.count_if(bad).alias("torn"),
    )
    records = pages.where(~bad).select("pull", F.explode("results").alias("record"))
    landed = records.select("pull", F.xxhash64("record").alias("a"), F.crc32("record").alias("b")).distinct()
    counts = landed.groupBy("pull").agg(F.count(F.lit(1)).alias("landed"))
    return totals.join(counts, "pull", "left").select(
        "pull", "expected", F.coalesce("landed", F.lit(0)).alias("landed"), "torn"
    )
