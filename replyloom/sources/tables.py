"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from replyloom.session import spread

MESSAGES = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("inbound", T.BooleanType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("response_tweet_id", T.StringType()),
        T.StructField("in_response_to_tweet_id", T.LongType()),
    ]
)
# A token that no table contains, so that text such as "NA" stays text.
NO_NULL_TOKEN = "\u0000"
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def read_messages(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, form: str | None = None
) -> DataFrame:
    """Raw messages from CSV or Parquet with the declared schema.

    Tweets hold line breaks, so a CSV file is read by one task and then dealt out
    to all; store large message tables as Parquet, where files are split and
    column and filter pruning reach the scan.
    """
    form = form or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read.schema(MESSAGES)
    messages = spread(reader.options(**CSV).csv(path)) if form == "csv" else reader.parquet(path)
    return messages.select(*(columns or MESSAGES.fieldNames()))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """An all-text CSV table: identifiers keep leading zeros and blanks stay blank."""
    reader = spark.read.options(**CSV, nullValue=NO_NULL_TOKEN, inferSchema=False)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path).na.fill("")


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    if form == "csv":
        options = {k: v for k, v in CSV.items() if k != "multiLine"}
        df.write.mode(mode).options(
            **options, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        df.write.mode(mode).parquet(path)


def holds_rows(spark: SparkSession, path: str, form: str = "parquet") -> bool:
    """Whether a table exists at ``path`` and has at least one row."""
    try:
        table = spark.read.options(**CSV).csv(path) if form == "csv" else spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return not table.isEmpty()


def write_if_empty(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Write, but never over a table that already has rows."""
    if holds_rows(df.sparkSession, path, form):
        raise ValueError(f"{path} already has rows; archive it before generating another run.")
    write_table(df, path, form, mode="overwrite")
