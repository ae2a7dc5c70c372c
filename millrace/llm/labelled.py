"""Labelled rows for fitting: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(column: str, divisor: int) -> Column:
    """CRC-32 of an id's text modulo ``divisor``; of a null id that of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def labelled(labels: DataFrame, label: str, usable: Column, id_col: str = "doc_id") -> DataFrame:
    """All usable labelled ids: ``doc_id, label``. An id labelled more than once takes its least label."""
    return labels.filter(usable & F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(id_col).alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("label"))


def sample(labels: DataFrame, label: str, usable: Column, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` of the labelled ids of each class, the first by hash: ``doc_id, label``."""
    rows = labelled(labels, label, usable, id_col)
    order = F.xxhash64("doc_id"), F.col("doc_id")
    return rows.filter("label = 0").orderBy(*order).limit(per_class).unionByName(
        rows.filter("label = 1").orderBy(*order).limit(per_class))
