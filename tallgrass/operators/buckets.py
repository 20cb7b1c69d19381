"""Tables stored by buckets of a key: joins and aggregates by that key need no shuffle.

A table is a folder of Parquet files. The catalog knows it only while it is written or
opened, so nothing is left there, and any later session can open the folder again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a table, as Spark estimates them, that go into one bucket.
BUCKET_BYTES = 64 << 20


#: Sizes from here on are what the optimizer says of a table it knows nothing about.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(table: DataFrame) -> int | None:
    """The optimizer's size of ``table``, None where it has none. Runs no job."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def buckets_for(table: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets a stored ``table`` needs: by the size of its files, and one for each task slot at least.

    The size is the optimizer's, so this runs no job.
    """
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-size // bucket_bytes))


def bucket_session(spark: SparkSession, buckets: int) -> SparkSession:
    """A session whose shuffles have as many partitions as the tables have buckets, so that they meet without another.

    Adaptive execution is off in it: partitions that must stay those of the buckets leave it
    nothing to change. The settings of ``spark`` stay as they are.
    """
    inner = spark.newSession()
    inner.conf.set("spark.sql.adaptive.enabled", "false")
    inner.conf.set("spark.sql.shuffle.partitions", buckets)
    inner.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    # Rows are dealt by bucket before they are written, so a task need not sort, and hold, all of its own to write bucket by bucket.
    inner.conf.set("spark.sql.maxConcurrentOutputFileWriters", 8)
    # A folder that a broken run has left half written is written anew.
    inner.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    return inner


def write_buckets(rows: DataFrame, place: str, key: str, buckets: int) -> None:
    """Store ``rows``, of a :func:`bucket_session`, each bucket in files of its own. What is at ``place`` goes."""
    spark, name = rows.sparkSession, _name()
    rows.write.format("parquet").mode("overwrite").bucketBy(buckets, key).option("path", place).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is an external one


def schema_of(table: DataFrame) -> str:
    """The columns of a table as :func:`read_buckets` takes them."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)


def read_buckets(spark: SparkSession, place: str, key: str, buckets: int, schema: str) -> DataFrame:
    """A stored table, partitioned by ``key`` as it was written. An empty one has no files, so ``schema`` is asked for."""
    name, quoted = _name(), place.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{quoted}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _name() -> str:
    return f"tallgrass_{uuid.uuid4().hex}"
