"""Helpers shared by the corpus operators: tables, word rules, and the library's scratch space in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, filesystem, free, made, remove, scratch

__all__ = ["LOWER", "UPPER", "WORD", "ascii_lower", "cut", "filesystem", "free", "made", "n_words", "remove", "scratch", "table"]

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column):
    return F.translate(column, UPPER, LOWER)


def n_words(text):
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
