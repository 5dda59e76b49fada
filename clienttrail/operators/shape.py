"""Small reshaping helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_rows(
    df: DataFrame,
    names: Sequence[str],
    rows: Sequence[Sequence[Column | str]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Turn each input row into the given rows; a plain string is a literal.

    Narrow, so it is meant for one-row summaries and for a fixed handful of rows per client.
    """
    structs = [
        F.struct(
            *[
                (F.lit(v) if isinstance(v, str) else v).alias(n)
                for n, v in zip(names, row, strict=True)
            ]
        )
        for row in rows
    ]
    return df.select(*keep, F.inline(F.array(*structs)))
