"""Topics of text lines. Needs the public Spark Kafka connector on the class path."""

from pyspark.sql import DataFrame, SparkSession, functions as F

TRAFFIC_TOPIC = "traffic"


def kafka_options(
    servers: str, topic: str = TRAFFIC_TOPIC, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options: the whole topic from its first line on."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(
    spark: SparkSession, servers: str, topic: str = TRAFFIC_TOPIC, **options
) -> DataFrame:
    """A stream with one `value` per line."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return reader.load().select(F.col("value").cast("string").alias("value"))
