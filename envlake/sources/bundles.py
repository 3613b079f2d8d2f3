"""Landed documents as files of one document each and as bundles of many.

A file per document costs a listing, a commit and a share of a task each, so that many
small documents are landed in bundles: Parquet files with a row (path, content) per
document. The path is the one the document would have as a file of its own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.errors import is_missing_path

BUNDLE_DDL = "path string, content string"


def write_bundles(files: DataFrame, folder: str) -> None:
    """Append documents (path, content) as they are; one bundle per task, whatever their number."""
    files.select("path", "content").write.mode("append").parquet(folder)


def read_documents(spark: SparkSession, files: str, bundles: str, path: Column) -> DataFrame | None:
    """(path, content) of every JSON file below ``files``, named by ``path``, and of all bundles; None without either."""

    def single() -> DataFrame:
        rows = spark.read.text(files, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
        return rows.select(path.alias("path"), F.col("value").alias("content"))

    found = []
    for read in (single, lambda: spark.read.schema(BUNDLE_DDL).parquet(bundles)):
        try:
            found.append(read())
        except AnalysisException as missing:
            if not is_missing_path(missing):
                raise
    return found[0].unionByName(found[-1]) if len(found) > 1 else next(iter(found), None)
