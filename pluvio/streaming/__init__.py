"""Landing -> bronze -> fact as one Structured Streaming query (T1)."""

from pluvio.streaming.medallion import (
    batch_job_id,
    ensure_fact_table,
    envelope_batch,
    envelope_stream,
    medallion_batch,
    stream_medallion,
)

__all__ = ["batch_job_id", "ensure_fact_table", "envelope_batch", "envelope_stream", "medallion_batch", "stream_medallion"]
