"""Key/value jobs: record hooks and the keyed aggregate after them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linklake import schemas
from linklake.session import bound_batches

Hook = Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]]


def apply_hook(records: DataFrame, hook: Hook, schema: StructType = schemas.KEY_VALUE) -> DataFrame:
    """Run a user function over batches of readable records.

    The hook sees every column: record fields, offset and length, and the index
    row's columns when records were fetched by coordinates. Batches are bounded for the
    session, as payloads come twice in a worker: as Arrow columns and as objects.
    """
    bound_batches(records.sparkSession)
    return records.where(F.col("error").isNull()).mapInPandas(hook, schema)


def reduce_by_key(pairs: DataFrame, reducer: Column | None = None, key: str = "key") -> DataFrame:
    """One row a key. The reducer is an aggregate expression, by default the sum
    of ``val``: partly aggregated before the shuffle, so a hot key is cheap."""
    return pairs.groupBy(key).agg((F.sum("val") if reducer is None else reducer).alias("val"))
