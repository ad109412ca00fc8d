"""The row-local stages on a stream: records in, keyed cells out, and running block sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.lexical import extract_features, normalize
from kinfold.operators.cells import flatten
from kinfold.operators.keys import block_sizes, generate_keys
from kinfold.options import Options
from kinfold.sources.readers import with_record_id


def keyed_stream(stream: DataFrame, key_columns: tuple[str, ...], options: Options = Options()) -> DataFrame:
    """Keyed cells of a streaming DataFrame; the record key must come from the data, a stream has no stable row number."""
    if not key_columns:
        raise ValueError("a stream needs key columns")
    records = with_record_id(stream, key_columns, source="stream", has_file=False)
    cells = extract_features(normalize(flatten(records, options.source.skip_leading_columns), options.lexical))
    return generate_keys(cells, options.keys)


def running_block_sizes(stream: DataFrame, key_columns: tuple[str, ...], options: Options = Options()) -> DataFrame:
    """Rows (block_key, size) so far, for output mode update or complete; the keys bound the state."""
    return block_sizes(keyed_stream(stream, key_columns, options)).select("block_key", F.col("size"))
