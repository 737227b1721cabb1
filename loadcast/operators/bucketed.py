"""Keyed tables stored in buckets of their key, so that joining them on it needs no shuffle.

Rows are dealt to the buckets before they are written, so each bucket is one
sorted file; tables with the same number of buckets are then joined bucket by
bucket.  Writing costs the shuffle once; every read after that has none.  A key
stands once in a keyed table, so no bucket is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadcast.session import target_partitions


def bucket_count(df: DataFrame) -> int:
    """Buckets of about the advisory partition size, the session's shuffle partitions at least."""
    return target_partitions(df) or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def write_buckets(kv: DataFrame, table: str, path: str, buckets: int, key: str = "key") -> DataFrame:
    """``kv`` as a table in ``buckets`` buckets of its key, sorted by it; fails if the table exists."""
    dealt = kv.repartition(buckets, key)  # the same hash as the buckets': one file each
    dealt.write.format("parquet").mode("errorifexists").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return kv.sparkSession.table(table)
