"""Several outputs of one pass: a tagged, partitioned write whose outputs are read back by tag.

``split`` and side outputs as plain filters read their input once an output.
Here the input is read once: each row is written with the tags it has, one
folder a tag, and every output is a read of its own folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_dir

TAG = "_tag"


def _written(df: DataFrame, outputs: dict[str, Column], path: str) -> dict[str, DataFrame]:
    tags = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in outputs.items()]))
    df.select("*", F.explode(tags).alias(TAG)).write.mode("overwrite").partitionBy(TAG).parquet(path)
    rows = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(TAG, T.StringType())])).parquet(path)
    return {name: rows.where(F.col(TAG) == name).drop(TAG) for name in outputs}


def split_once(df: DataFrame, outputs: dict[str, Column], path: str | None = None) -> dict[str, DataFrame]:
    """The rows of each output (name to condition), written in one pass over ``df`` to ``path`` (default: the shared checkpoint folder).

    A row goes to every output whose condition is true, or to none. An output
    without rows is an empty frame of the same columns.
    """
    if not outputs:
        return {}
    return _written(df, outputs, path or f"{checkpoint_dir(df.sparkSession)}/outputs-{uuid.uuid4().hex}")


def foreach_batch_outputs(outputs: dict[str, Column], sinks: dict[str, Callable[[DataFrame, int], None]], folder: str):
    """A ``foreachBatch`` function: each micro-batch is read once, split, and handed to each output's sink.

    The split of batch n lies in ``folder`` and is overwritten if the batch is run again.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        found = _written(batch, outputs, f"{folder}/{batch_id}")
        for name, sink in sinks.items():
            sink(found[name], batch_id)
    return run
