"""Extension points: a user's functions inside the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_samples(df: DataFrame, transform: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a user's function to Arrow batches of samples; for what column functions cannot say."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield transform(batch)

    return df.mapInPandas(apply, schema)


def read_samples(
    lines: DataFrame,
    read_tokens: Callable[[Column], Column],
    read_pair: Callable[[Column], tuple[Column, Column]],
    line: str = "line",
) -> DataFrame:
    """Token pairs of corpus lines by a reader's own rules: how a line is cut, and which pair it makes."""
    cut = lines.withColumn("_tokens", read_tokens(lines[line])).drop(line)
    source, target = read_pair(cut["_tokens"])
    return cut.withColumns({"source": source, "target": target}).drop("_tokens")


def read_many_samples(
    lines: DataFrame, read: Callable[[str], Iterator[tuple[list[str], list[str]]]], line: str = "line",
) -> DataFrame:
    """Any number of token pairs per corpus line by a reader of its own, beside the line's other columns.

    The reader is a table function joined laterally, in Arrow batches: its pairs stream out one by one, and a line
    of many pairs is never held together. A null line, and one without pairs, gives no row.
    """

    class Reader:
        def eval(self, text: str) -> Iterator[tuple[list[str], list[str]]]:
            if text is not None:
                yield from read(text)

    pairs = F.udtf(Reader, returnType="source array<string>, target array<string>", useArrow=True)
    return lines.lateralJoin(pairs(F.col(line).outer())).drop(line)
