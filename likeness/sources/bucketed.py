"""Tables stored in hash buckets, so that joins and groups by the bucket columns need no shuffle.

A bucketed table is Parquet files below one folder and an entry in the session's catalogue that
names columns and buckets. The entry is made anew in every session that opens the folder.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession


def table_name(path: str) -> str:
    return "likeness_" + hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, *, partition: str | None = None,
                   dealt: bool = False) -> DataFrame:
    """Write ``df`` to the new folder ``path``, one file a bucket (and value of ``partition``), sorted by
    the keys, and return it as a bucketed table. ``dealt`` says that a task holds rows of one bucket only."""
    rows = df if dealt else df.repartition(buckets, *keys)
    writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table_name(path))
    return df.sparkSession.table(table_name(path))


def read_bucketed(spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int, *,
                  partition: str | None = None) -> DataFrame:
    """The bucketed table that ``write_bucketed`` left in ``path``, in this or another session."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        folders = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {folders} CLUSTERED BY ({', '.join(keys)}) "
                  f"SORTED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
