"""Log streams and dimension tables.

Endpoints, topics and credentials are parameters; nothing is embedded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.schemas import IP_RANGE, ONLINE_USER


def read_syslog_kafka(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "latest", options: dict | None = None,
                      min_partitions: int | None = None,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1: Kafka topic of UTF-8 lines as ``value`` plus ``seq`` (the offset),
    ``partition`` and ``kafka_ts``.  Needs the Spark Kafka connector on the
    classpath (not bundled with this install).

    ``min_partitions`` splits each topic partition's offset range over more
    tasks, so a topic with few partitions still spreads the parse over the
    cluster; ``max_offsets_per_trigger`` bounds a micro-batch."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.col("offset").alias("seq"), "partition",
                                F.col("timestamp").alias("kafka_ts"))


def read_text_stream(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """S4 (stream form): new text files under ``path`` as ``value`` lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S4: a UTF-8 text file or folder as ``value`` lines."""
    return spark.read.text(path)


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S5: newline-delimited socket text (for demos; not fault tolerant)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def read_online_users(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                      jdbc_url: str | None = None, table: str | None = None,
                      properties: dict | None = None) -> DataFrame:
    """S2: the online-user dimension (``framedip``, ``loginname``,
    ``seen_at``) from files or over JDBC.  Only the needed columns are
    read; a table without an ordering column gets ``seen_at`` = 0."""
    if jdbc_url:
        df = spark.read.jdbc(jdbc_url, table, properties=properties or {})
    else:
        df = spark.read.format(fmt).load(path)
    order = F.col("seen_at").cast("bigint") if "seen_at" in df.columns else F.lit(0).cast("bigint")
    return df.select(F.col("framedip").cast("string"), F.col("loginname").cast("string"),
                     order.alias("seen_at"))


def read_ip_ranges(spark: SparkSession, path: str, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """S3: the geo-IP range table (``startip``, ``endip`` inclusive,
    ``local``).  CSV/JSON inputs are read with the fixed schema."""
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        reader = reader.schema(IP_RANGE)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.select(F.col("startip").cast("bigint"), F.col("endip").cast("bigint"),
                     F.col("local").cast("string"))


def register_view(df: DataFrame, name: str = "nat_flow") -> DataFrame:
    """S6: expose a (streaming) DataFrame to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
