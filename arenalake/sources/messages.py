"""Streams of messages with a ``value`` column."""

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """One Kafka topic. Needs the Kafka connector package of the running Spark.

    ``options`` are passed on, such as ``startingOffsets`` or ``maxOffsetsPerTrigger``.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )


def text_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """A folder of text files, one message per line, as the same kind of stream."""
    return spark.readStream.format("text").schema("value string").options(**options).load(path)
