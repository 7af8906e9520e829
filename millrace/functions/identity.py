"""Device and location labels of sensor readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import prefix, strip


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _last_part(column: Column) -> Column:
    return F.substring_index(column, "_", -1)


def device_id_full(device, room, row) -> Column:
    """``device_<10 characters>``, else ``room_<10 characters>``, else ``default_<row>``."""
    device, row = _col(device), _col(row)
    labels = [F.concat(F.lit("device_"), prefix(_last_part(device), 10))]
    if room is not None:
        labels.append(F.concat(F.lit("room_"), prefix(_col(room), 10)))
    return F.coalesce(*labels, F.concat(F.lit("default_"), row.cast("string")))


def device_id_incremental(device, row) -> Column:
    """``dev_<15 characters>``, else ``row_<row>``."""
    return F.coalesce(
        F.concat(F.lit("dev_"), prefix(_last_part(_col(device)), 15)),
        F.concat(F.lit("row_"), _col(row).cast("string")),
    )


def location(column) -> Column:
    return F.coalesce(prefix(strip(column), 10), F.lit("unknown"))
