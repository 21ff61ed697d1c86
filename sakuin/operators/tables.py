"""Tables that several plans read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """df as a table that several others read: written to the checkpoint folder that the session names, so that it is computed once, a lost
    executor costs no parsing and readers take the columns that they need; without a folder, a cache, whose lost parts are made anew."""
    folder = df.sparkSession.sparkContext.getCheckpointDir()
    if not folder:
        return df.cache()
    path = f"{folder}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many tasks as shuffles have, however few bytes it holds, for work that takes long a row. Spark
    leaves it out where df is dealt by the same keys in the same order already."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
