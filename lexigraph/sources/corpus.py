"""Text files as documents, and snapshots of them for change detection."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..operators.triples import fixed_batches


def _relative(path, root: str):
    """The path under root, decoded, with forward slashes."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^.*?" + re.escape(root.rstrip("/").split(":", 1)[-1].lstrip("/")) + "/", "")


def documents(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """(seq, doc_id, text) of every file under root; doc_id is the path under root, and seq counts from 0 in its order."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    own = files.select(_relative(F.col("_metadata.file_path"), root).alias("doc_id"), F.col("value").alias("text"))
    return fixed_batches(own, 1, "doc_id").select(F.col("batch").alias("seq"), "doc_id", "text")


def snapshot(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """(doc_id, checksum, modified_at) of every file under root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select(_relative(F.col("path"), root).alias("doc_id"), content_hash("content").alias("checksum"), F.col("modificationTime").cast("double").alias("modified_at"))
