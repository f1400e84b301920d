"""For trying things out: totals held in driver memory, or printed. Not for large data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.totals import totals
from tillflow.sources.messages import parse_sales


def start_memory_totals(
    messages: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Complete totals as an in-memory table of the same name."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    result = totals(parse_sales(messages), table)
    writer = result.writeStream.outputMode("complete").format("memory").queryName(table)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def print_totals(result: DataFrame, rows: int = 20) -> None:
    result.show(rows, truncate=False)
