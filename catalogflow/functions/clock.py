"""Time expressions. The time is always an argument, so results can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone and layout of the text timestamps.
TEXT_ZONE = "+07:00"
TEXT_LAYOUT = "yyyy-MM-dd HH:mm:ss"


def local_text(ts: Column, zone: str = TEXT_ZONE) -> Column:
    """An instant as wall-clock text in ``zone``, whatever the session zone is."""
    wall = F.convert_timezone(
        F.current_timezone(), F.lit(zone), ts.cast("timestamp_ntz")
    )
    return F.date_format(wall, TEXT_LAYOUT)


def ago_text(ts: Column, days: int = 7, zone: str = TEXT_ZONE) -> Column:
    """Text of the instant ``days`` before ``ts``."""
    return local_text(ts - F.make_dt_interval(F.lit(days)), zone)


def parse_local_text(text: Column, zone: str = TEXT_ZONE) -> Column:
    """The instant behind a text timestamp; null where the text is not one."""
    wall = F.try_to_timestamp(text, F.lit(TEXT_LAYOUT)).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), wall).cast("timestamp")
