"""Streaming.

The reference has **no** streaming operators (no stream source, watermark
or event-time state); its "near real time" mode is a batch rerun on the
latest rows.  This module only adapts the batch operators to Structured
Streaming so the same job can run on each micro-batch: ``foreachBatch``
hands every micro-batch to a batch function (e.g. resampling + features +
recommendation of the latest rows) and writes its result idempotently.
No stream-only operator is added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def run_batch_job_on_stream(stream: DataFrame, job: Callable[[DataFrame], DataFrame],
                            out_path: str, checkpoint: str, trigger_once: bool = True):
    """Apply ``job`` to every micro-batch and append its output as Parquet.

    ``checkpoint`` must be a shared, durable folder (the query restarts from
    it after a driver or executor loss); each batch is written once per
    batch id, so retries do not duplicate output.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
