"""Message sources: Kafka, or replay files of the same record shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from gaugeline.config import Settings
from gaugeline.schemas import KAFKA_RECORD


@dataclass(frozen=True)
class KafkaSource:
    """A topic read from its earliest offset.

    ``min_partitions`` splits topic partitions over more tasks than the topic
    has partitions; ``max_offsets_per_trigger`` bounds a micro-batch. Lost
    offsets are tolerated. Batch reads may be narrowed with ``starting_offsets``
    and ``ending_offsets``.
    """

    topic: str
    bootstrap_servers: tuple[str, ...]
    starting_offsets: str = "earliest"
    ending_offsets: str | None = None
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_settings(cls, settings: Settings, **options) -> KafkaSource:
        return cls(settings.topic, settings.bootstrap_servers, **options)

    def options(self, *, streaming: bool) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": ",".join(self.bootstrap_servers),
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": "false",
        }
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        if streaming and self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if not streaming and self.ending_offsets is not None:
            options["endingOffsets"] = self.ending_offsets
        return {**options, **self.extra}

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options(streaming=True)).load()

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self.options(streaming=False)).load()


@dataclass(frozen=True)
class ReplaySource:
    """Parquet files of Kafka-shaped records, oldest file first."""

    path: str
    max_files_per_trigger: int | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(KAFKA_RECORD)
        if self.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.parquet(self.path)

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(KAFKA_RECORD).parquet(self.path)
