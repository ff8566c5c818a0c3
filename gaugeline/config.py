"""Settings of a deployment, read from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    topic: str = "sensor-events"
    bootstrap_servers: tuple[str, ...] = ("localhost:9092", "localhost:9094", "localhost:9096")
    # Shared storage; there is no default because a cluster has no common /tmp.
    lake_root: str | None = None
    checkpoint_root: str | None = None
    # Streams keep this number for the life of their checkpoint.
    shuffle_partitions: int = 6
    # First split of batch shuffles, merged again as their size allows.
    batch_partitions: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        servers = env.get("KAFKA_BOOTSTRAP_SERVERS")
        return cls(
            topic=env.get("KAFKA_TOPIC", cls.topic),
            bootstrap_servers=split_servers(servers) if servers else cls.bootstrap_servers,
            lake_root=env.get("DATALAKE_ROOT"),
            checkpoint_root=env.get("CHECKPOINT_ROOT"),
            shuffle_partitions=int(env.get("SPARK_SHUFFLE_PARTITIONS", cls.shuffle_partitions)),
        )


def split_servers(text: str) -> tuple[str, ...]:
    """``"a:1, ,b:2"`` -> ``("a:1", "b:2")``."""
    return tuple(part for part in map(str.strip, text.split(",")) if part)
