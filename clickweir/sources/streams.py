"""Order message streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schemas, workspace


@dataclass(frozen=True)
class StreamSource:
    """Where order messages come from.

    ``format="kafka"`` needs the Kafka connector on the cluster's class path. A
    file format reads a folder; ``schema`` is then required and should offer the
    message columns it has.
    """

    format: str = "kafka"
    topic: str | None = None
    brokers: str | None = None
    path: str | None = None
    schema: T.StructType | None = None
    # "latest", "earliest" or the JSON of per-partition offsets.
    starting_offsets: str = "latest"
    # Most messages (Kafka) or files one micro-batch may take.
    max_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        chosen = dict(self.options)
        if self.format == "kafka":
            if not (self.brokers and self.topic):
                raise ValueError("a Kafka source needs brokers and topic")
            chosen |= {
                "kafka.bootstrap.servers": self.brokers,
                "subscribe": self.topic,
                "startingOffsets": self.starting_offsets,
            }
            if self.max_per_trigger:
                chosen["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        elif self.max_per_trigger:
            chosen["maxFilesPerTrigger"] = str(self.max_per_trigger)
        return chosen


def order_stream(spark: SparkSession, source: StreamSource) -> DataFrame:
    """Messages with topic, partition, offset, timestamp, key and text value."""
    reader = spark.readStream.format(source.format).options(**source.reader_options())
    if source.schema is not None:
        reader = reader.schema(source.schema)
    raw = reader.load(source.path) if source.path else reader.load()
    return raw.select(*[
        F.col(c).cast("string").alias(c) if c in ("key", "value") else F.col(c)
        for c in schemas.MESSAGE_COLUMNS if c in raw.columns
    ])


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream; a table that is one file is found by its name."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if workspace.is_dir(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)
