"""Helpers shared by the operators: stored tables and UTF-8 words."""

import atexit
import contextlib
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import shared_folder

#: What separates words: space and the five ASCII controls from tab to carriage return.
SPACE = " \t\n\u000b\f\r"

_written: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The lineage ends there, later steps read only the columns they use, and a lost executor
    costs nothing that was written. The folders are removed when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have a file or folder of ours removed when the driver's Python ends."""
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))


def _remove() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):  # at exit there is nobody left to tell
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(values) -> pd.Series:
    """Values of a column as objects: what Arrow turns into one array, nulls included."""
    return pd.Series([None if x is None or x is pd.NA or x != x else x for x in values], dtype=object)


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words of a text. ``bytes.split`` knows ASCII white space only, as ``SPACE``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def text_key(column: str = "text") -> F.Column:
    """A number that tells rows with one id but different texts apart."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
