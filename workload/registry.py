"""Where queries and their SQL are collected."""

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame``, with the SQL that must agree."""
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return keep


def ctes(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def exploded(df, column, *keys):
    """One row per element, so that single values are compared. Empty arrays go after the
    explosion: what Spark filters before an inner one computes the array a second time."""
    from pyspark.sql import functions as F
    return df.select(*keys, F.posexplode_outer(column).alias("pos", "val")).where("pos IS NOT NULL").withColumn(
        "val", F.round(F.col("val").cast("double"), 6) + 0.0)


def exploded_sql(source: str, column: str, *keys: str) -> str:
    names = ", ".join(keys)
    return (f"SELECT {names}, CAST(pos - 1 AS INTEGER) AS pos, round({column}[pos]::DOUBLE, 6) + 0.0 AS val FROM "
            f"(SELECT {names}, {column}, unnest(range(1, len({column}) + 1)) AS pos FROM {source})")
