"""Kafka source/sink options.

The connector jar is not bundled; these helpers only build the option maps
(unit-tested) used with ``readStream.format("kafka")`` / ``write.format("kafka")``.
"""

from __future__ import annotations


def source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                   max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def sink_options(bootstrap_servers: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
