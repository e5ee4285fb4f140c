"""A unique, ordered row number for documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import stored

ROW = "__row"


def numbered(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """ROW (long, unique, ascending with ``key``,
    nulls first, then by text) and the columns of ``docs`` in a struct ``kept``.

    Where the key is an integer, without nulls and repeats, it is the number.
    Otherwise the rows are sorted by range and written once, numbered in that
    order."""
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    if isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        n, filled, distinct = docs.select(key).agg(F.count("*"), F.count(key), F.count_distinct(key)).first()
        if n == filled == distinct:
            return docs.select(F.col(key).cast("long").alias(ROW), kept)
    order = [F.col(f"kept.{key}").asc_nulls_first(), F.col("kept.text").asc_nulls_first()]
    rows = (docs.select(kept).repartitionByRange(*order).sortWithinPartitions(*order)
            .select(F.monotonically_increasing_id().alias(ROW), "kept"))
    return stored(docs.sparkSession, rows, "numbered")
