"""Delimited, text and parquet inputs with a stable record key, and the truth file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from kinfold.options import SourceOptions

RESERVED = ("record_id", "source")
CELLS = "_cells"
#: A file of a parquet scan may have 2 ** ROW_BITS rows, and a scan 2 ** (63 - ROW_BITS) files.
ROW_BITS = 38
TRUTH_SCHEMA = T.StructType([T.StructField("ref_id", T.StringType(), False), T.StructField("truth_id", T.StringType(), False)])


def _key(columns: list[str], df: DataFrame) -> Column:
    if len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(columns[0]).cast("long")
    return F.xxhash64(*columns)


def with_record_id(df: DataFrame, key_columns: tuple[str, ...] = (), source: str | None = None, has_file: bool = True) -> DataFrame:
    """df with record_id and source; of data columns with these names the values are replaced.

    record_id comes from the key columns if given (one integer column as it is, else a 64-bit hash: among n keys about
    n * n / 4e19 pairs share one), else from file and row of a parquet scan, else from Spark's row number, which a
    checkpoint then keeps fixed for the run.
    """
    if key_columns:
        record = _key(list(key_columns), df)
    else:
        record = F.monotonically_increasing_id()
    name = F.lit(source) if source is not None else (F.input_file_name() if has_file else F.lit(""))
    return df.withColumns({"record_id": record, "source": name})


def _numbered(df: DataFrame, source: str | None) -> DataFrame:
    """A parquet scan with record_id = file number * 2 ** ROW_BITS + row, the files in order of their paths: no two are equal."""
    named = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    # a row for each file; only their names are ordered in one task
    files = df.select(F.col("_metadata.file_path").alias("__path")).distinct()
    files = files.select("__path", (F.row_number().over(Window.orderBy("__path")) - 1).cast("long").alias("__number"))
    packed = F.when(F.col("__row") < 1 << ROW_BITS, F.shiftleft("__number", ROW_BITS) + F.col("__row")).otherwise(F.raise_error(F.lit(f"a file has more than 2 ** {ROW_BITS} rows")).cast("long"))
    keyed = named.join(files, F.col("__file") == F.col("__path")).withColumns({"record_id": packed, "source": F.lit(source) if source is not None else F.col("__file")})
    return keyed.drop("__file", "__row", "__path", "__number")


def read_records(spark: SparkSession, path: str, options: SourceOptions = SourceOptions(), source: str | None = None) -> DataFrame:
    """Rows of the input with record_id and source; free text as one array column."""
    kind = options.input_format.lower()
    if kind in ("csv", "tsv"):
        reader = spark.read.option("header", options.input_has_header).option("sep", "\t" if kind == "tsv" else options.input_delimiter)
        df = reader.option("mode", "PERMISSIVE").option("multiLine", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
        if not options.key_columns:
            return _numbered(df, source)
    else:
        line = F.col("value")
        cells = F.split(line, options.text_split_regex) if options.text_split_regex else F.array(line)
        df = spark.read.text(path).select(cells.alias(CELLS))
    return with_record_id(df, options.key_columns, source)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Rows (ref_id, truth_id); the header line is skipped."""
    return spark.read.schema(TRUTH_SCHEMA).option("header", True).csv(path)
