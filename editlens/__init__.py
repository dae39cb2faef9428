"""editlens: edit-stream analytics as Spark DataFrame jobs.

Batch views over full history, event-time sliding windows, a ranked speed
snapshot, the batch+speed merge and ingest monitoring, all written as
``DataFrame -> DataFrame`` and ``Column -> Column`` functions so the same
logic runs in batch and in Structured Streaming.
"""

from editlens.config import DEFAULTS, Defaults

__all__ = ["DEFAULTS", "Defaults"]
