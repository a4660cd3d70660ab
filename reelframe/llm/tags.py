"""Tags in their compared form, and the current row of a track."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CACHE_ENTRIES = 1 << 18
_cache: dict[str, str] = {}


def compared(tag: str | None) -> str:
    """NFKC, lower case, without white space; '' for null."""
    if not tag:
        return ""
    got = _cache.get(tag)
    if got is None:
        got = "".join(unicodedata.normalize("NFKC", tag).lower().split())
        if len(_cache) >= _CACHE_ENTRIES:
            _cache.clear()
        _cache[tag] = got
    return got


@F.pandas_udf(T.ArrayType(T.StringType()))
def compared_tags(tags: pd.Series) -> pd.Series:
    """The tags of each row in their compared form, in order, without null and empty ones; null array -> empty."""
    return tags.map(lambda a: [] if a is None else [x for x in map(compared, a) if x])


def current_rows(df: DataFrame, key: str, at: str, keep: list[str]) -> DataFrame:
    """Of each ``key`` the row with the latest ``at``: columns key and ``keep``.

    Null ``at`` counts as earliest, rows with a null key do not count, and of rows with the same ``at`` the one
    with the greatest content hash is kept, so that repeated rows and any row order give the same result.
    An aggregate with map-side combine, so a key of very many rows is no hot task.
    """
    cols = [F.col(f"`{c}`") for c in keep]
    order = F.struct(F.col(f"`{at}`").alias("at"), F.xxhash64(*cols).alias("h"))
    rows = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("_id"), order.alias("_o"), F.struct(*cols).alias("_v"))
    got = rows.groupBy("_id").agg(F.max_by("_v", "_o").alias("_v"))
    return got.select(F.col("_id").alias(key), "_v.*")
