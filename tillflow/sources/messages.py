"""Message streams. Every source gives the same frame: one BINARY `value` per message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.lines import is_line, line_of_piece, message_pieces, sales_fields

# Fixed value: the columns of Spark's binaryFile source.
FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = 100,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    **more: str,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **more}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a topic; needs the Kafka connector of the same Spark version on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return reader.load().select("value")


def whole_file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Each file is one message of many lines."""
    reader = spark.readStream.format("binaryFile").schema(FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("content").alias("value"))


def parquet_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Each row of a Parquet file with a BINARY `value` is one message."""
    reader = spark.readStream.schema("value BINARY")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def lines_of(messages: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Messages to lines as `message_lines` has them, worked out row by row and not within the array; a
    message without a value gives none."""
    pieces = messages.select(F.explode(message_pieces(F.col("value"))).alias("line"))
    if keep_blank:
        return pieces
    line = F.col("line")
    return pieces.where(is_line(line)).select(line_of_piece(line).alias("line"))


def parse_sales(messages: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Messages to sales lines. All in one stage: nothing is shuffled."""
    lines = lines_of(messages, keep_blank)
    return lines.select(sales_fields(F.col("line")).alias("data")).select("data.*")
