"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import prepare_session, scratch_path

# A word of the contracts: a run without space, tab, LF, VT, FF and CR.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]++"
# A side with at most this many rows (of under about 200 bytes) is broadcast.
FEW_ROWS = 100_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    several readers compute it once, and a lost executor recomputes nothing."""
    spark = prepare_session(df.sparkSession)
    path = f"{scratch_path(spark, name)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """Words of a text, in order (null: none), without a lambda per word."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.size(word_array(text)).cast("long")


def without(text: Column, chars: str) -> Column:
    """A text without the characters of the regex class ``chars``."""
    return F.regexp_replace(text, f"[{chars}]++", "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_if_counted(df: DataFrame, max_rows: int = FEW_ROWS) -> DataFrame:
    """Marks ``df`` for broadcast if a distributed count proves it small."""
    return F.broadcast(df) if df.count() <= max_rows else df
