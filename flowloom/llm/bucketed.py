"""Tables written in buckets of a key, which meet others on that key without a shuffle of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from flowloom.plans.staging import fresh_path


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written once to the shared folder, in as many buckets of ``key`` as there are shuffle partitions.

    The catalog entry is needed only to look the buckets up; the files stay in the shared folder.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(parts, key).option("path", fresh_path(spark, name)).option("compression", "zstd")
    writer.format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table
