"""Scoring a stream of names with a fitted model.

The reference scored names one at a time as a user typed them.  As a
Structured Streaming job that is the same ``predict_names`` operator on a
streaming DataFrame: stateless and map-only (no watermark, no state store),
each micro-batch scored as it arrives, written to a file sink.  The
checkpoint belongs to the output: unless one is named it lies in the output
folder, so a query restarted on the same output resumes where it stopped and
every row is scored exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from labelkit.operators.score import predict_names


def score_stream(
    stream: DataFrame,
    model: PipelineModel,
    keys: Sequence[str] = (),
    text_col: str = "name",
    use_first_token: bool = True,
) -> DataFrame:
    """``keys..., name, predicted_label, confidence`` for every arriving row."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame (spark.readStream...)")
    return predict_names(stream, model, keys, text_col, use_first_token)


def start_scoring(
    stream: DataFrame,
    model: PipelineModel,
    output_path: str,
    keys: Sequence[str] = (),
    text_col: str = "name",
    checkpoint_path: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    use_first_token: bool = True,
) -> StreamingQuery:
    """Start the scoring query with an append-mode parquet sink.

    ``available_now=True`` processes what is there and stops (batch-style
    catch-up); otherwise the query runs with the given trigger.
    """
    scored = score_stream(stream, model, keys, text_col, use_first_token)
    # Readers of the output skip names that begin with an underscore.
    ckpt = checkpoint_path or f"{output_path.rstrip('/')}/_checkpoint"
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(output_path)
