"""File manifest of a lake: path, rows and bytes of each data file written.

A run and a compaction append the files of their own folders, from the footers
of just these files (no data page is read). ``sources.files.unreadable_files``
compares it with what is stored, so it opens no file that is as it was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources.files import MANIFEST, few_list_tasks


def file_rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    """path, n_rows and n_bytes of the data files under ``folders`` that have a
    row; a file that is gone or broken is left out. Only footers are read: no
    column is asked for."""
    m = F.col("_metadata")
    with few_list_tasks(spark):
        files = (spark.read.schema("_none int").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
                 .option("ignoreCorruptFiles", "true").parquet(*folders))
    return (files.groupBy(m["file_path"].alias("path"), m["file_size"].alias("n_bytes")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select("path", "n_rows", "n_bytes"))


def record_files(spark: SparkSession, base: str, folders: list[str]) -> None:
    """Append the files of the given folders (that exist) to the manifest.
    Written again, a file is listed twice with the same figures."""
    if folders:
        file_rows(spark, folders).coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
