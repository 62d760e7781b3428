"""CSV report sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def write_report(df: DataFrame, folder: str, name: str, stamp: dt.datetime | None = None) -> str:
    """Write a report as CSV with header to ``<folder>/<name>_<timestamp>`` and give that path.

    Tasks write their part files side by side; a sorted report is sorted across the part files in name order.
    """
    path = f"{folder.rstrip('/')}/{name}_{(stamp or dt.datetime.now()).strftime('%Y%m%d%H%M%S%f')}"
    df.write.option("header", True).option("escape", '"').csv(path)
    return path
