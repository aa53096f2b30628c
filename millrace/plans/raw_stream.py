"""From a connector catalog and a raw landing table to a merged staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import ColumnSpec
from millrace.operators import dictionary as d
from millrace.operators.merge import merge_into_months
from millrace.operators.staging import CDC_MARK, stage


def stream_dictionary(connections: DataFrame, connection_id: str, stream: str) -> list[ColumnSpec]:
    """Column dictionary of one raw stream, from the catalog."""
    chosen = d.streams(d.connections_of(connections, [connection_id])).where(
        F.col("stream") == stream
    )
    columns = d.with_metadata_columns(d.stream_columns(chosen), chosen)
    return d.column_specs(columns)


def load_stream(
    raw: DataFrame,
    dictionary: list[ColumnSpec],
    execution_date,
    path: str,
    *,
    full_refresh: bool = False,
    incremental: bool = True,
    date_from=None,
    on_error: str = "fail",
    on_duplicate: str = "fail",
) -> list[str]:
    """Stage one run of a stream and merge it into its month partitions.

    Change data is staged as one row per key, so it needs no check for duplicates.
    """
    if any(c.name == CDC_MARK for c in dictionary):
        on_duplicate = "trust"
    staged = stage(
        raw, dictionary, execution_date,
        incremental=incremental and not full_refresh, date_from=date_from, on_error=on_error,
    )
    return merge_into_months(
        staged, path, full_refresh=full_refresh, on_duplicate=on_duplicate,
        order_by=("ab_emitted_at", "ab_id"), one_month=True,
    )
