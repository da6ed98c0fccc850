"""File sources and sinks for the raw feeds (S01, S02, S07).

The snapshot format: a header row, an empty field for NULL, ``true``/
``false`` booleans and timestamps written as
``2025-12-06 11:06:00.000000 UTC`` (the fraction is optional when read; the
zone is parsed, so the session's zone does not matter).  Blank strings are written quoted so
they stay blank (not NULL), and padding is kept: leading and trailing
spaces are part of the dirt the pipeline must clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contract import check_files

# The snapshot timestamp layout.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS VV"
TIMESTAMP_READ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS] VV"

# The CSV parser hands an unquoted empty field over as ``nullValue`` and a
# quoted one (``""``) as ``emptyValue``, then nulls whatever equals
# ``nullValue``.  Reading with a marker that never occurs in data as
# ``nullValue`` keeps the two apart: empty -> NULL, ``""`` -> blank string.
_READ_NULL_MARKER = "\ue000null\ue000"

_CSV_OPTIONS = {
    "header": "true",
    "escape": '"',  # a quote inside a quoted field is doubled; a backslash is an ordinary character
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": TIMESTAMP_FORMAT,
    "dateFormat": "yyyy-MM-dd",
    "timeZone": "UTC",
}


#: The flag of a row that does not parse whole, and its text as it stands in the file.
MALFORMED, MALFORMED_LINE = "dq_row_is_malformed", "malformed_line"


def csv_read_options(multi_line: bool = False, flag_malformed: bool = False) -> dict:
    """Reader options for the snapshot format (shared by batch and stream)."""
    # a short row is malformed whichever of its columns a query reads
    flag = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED_LINE, "columnPruning": "false"}
    mode = flag if flag_malformed else {"mode": "FAILFAST"}
    return {**_CSV_OPTIONS, "nullValue": _READ_NULL_MARKER, "emptyValue": "",
            "timestampFormat": TIMESTAMP_READ_FORMAT, "multiLine": str(multi_line).lower(), **mode}


def with_line(schema: T.StructType) -> T.StructType:
    """``schema`` and the column in which a permissive read puts a malformed row's text."""
    return T.StructType([*schema.fields, T.StructField(MALFORMED_LINE, T.StringType())])


def flagged(raw: DataFrame) -> DataFrame:
    """The row's text replaced by ``dq_row_is_malformed`` after it; the text of good rows is NULL."""
    columns = [c for c in raw.columns if c != MALFORMED_LINE]
    # Spark parses only the columns that a query reads and refuses one that reads the
    # malformed text alone.  So the flag names every column, in a part that is never
    # TRUE (a negative number of NULLs), and is the same in every query.
    n_nulls = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return raw.select(*columns, (F.col(MALFORMED_LINE).isNotNull() | (n_nulls < 0)).alias(MALFORMED), MALFORMED_LINE)


def load_feed_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Scan a CSV feed in which rows may be malformed: flagged, never dropped.

    A field that does not parse as its type is NULL, and so are fields that a
    short row lacks; the row's other fields are kept, ``dq_row_is_malformed`` is
    TRUE and ``malformed_line`` holds the row as it stands in the file (also for
    a row with fields too many).  Like any new raw column, both flow through
    staging and stop at the unified columns.
    """
    return flagged(spark.read.schema(with_line(schema)).options(**csv_read_options(multi_line, flag_malformed=True)).csv(path))


def read_feed_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Scan a CSV feed with its declared schema (no inference pass); a malformed row
    ends the load with an error (:func:`load_feed_csv` flags it instead).

    One record per line by default, so that Spark can split large files.  Pass
    ``multi_line=True`` for feeds whose quoted values hold line breaks; each of
    their files is read by one task, so they should land as many files.
    """
    return spark.read.schema(schema).options(**csv_read_options(multi_line)).csv(path)


def write_feed_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def append_feed_csv(df: DataFrame, path: str) -> None:
    """Land more files beside those of ``path``."""
    df.write.mode("append").options(**_CSV_OPTIONS).csv(path)


def read_feed_parquet(spark: SparkSession, path: str, schema: T.StructType, every_file: bool = False) -> DataFrame:
    """Scan a Parquet feed.  Columns beyond the declared ones are left out; one that
    is missing, renamed or of another type is an error, not NULLs."""
    check_files(spark, path, schema, extra_allowed=True, every_file=every_file)
    return spark.read.schema(schema).parquet(path)
