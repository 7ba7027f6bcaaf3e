"""Staged JSON documents and topic CSV datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulse.schema import CONTENT, CORRUPT_COLUMN, STAGED_ORDER, THREAD, lenient

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    # text comes back as it went in: no trimming, null and "" told apart
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]xxx",
    "mode": "PERMISSIVE",
}
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
}


def no_data(error: AnalysisException) -> bool:
    """True if a read failed because there is nothing at the path (yet)."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _json(spark: SparkSession, path: str, schema: T.StructType, streaming: bool,
          max_files_per_trigger: int | None, clean_source: str | None = None,
          archive_dir: str | None = None, sequence: bool = False) -> DataFrame:
    if sequence:
        schema = T.StructType([*schema.fields, *[T.StructField(c, T.LongType()) for c in STAGED_ORDER]])
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(lenient(schema)).options(**JSON_OPTIONS)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))   # W3
    if streaming and clean_source:
        # K5: consumed files are archived or deleted once committed
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.json(path)


def read_threads(spark: SparkSession, path: str, streaming: bool = False,
                 max_files_per_trigger: int | None = None, clean_source: str | None = None,
                 archive_dir: str | None = None, sequence: bool = False) -> DataFrame:
    """Staged thread documents (post + ``comments``); ``sequence`` reads their
    staging order (K2) along.

    A line that is not JSON becomes a row with only ``_corrupt_record`` set;
    the quarantine (F7) routes it aside while the other lines are read.
    """
    return _json(spark, path, THREAD, streaming, max_files_per_trigger, clean_source, archive_dir, sequence)


def read_comments(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None, clean_source: str | None = None,
                  archive_dir: str | None = None, sequence: bool = False) -> DataFrame:
    """Staged flat comment documents; ``sequence`` as for threads."""
    return _json(spark, path, CONTENT, streaming, max_files_per_trigger, clean_source, archive_dir, sequence)


def read_topic_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An accumulated topic dataset; missing or empty -> empty.

    ``schema`` is the CSV-side schema (arrays are stored joined, see P9).
    """
    try:
        return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    except AnalysisException as e:
        if not no_data(e):
            raise
        return spark.createDataFrame([], schema)
