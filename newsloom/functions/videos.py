"""Channel and video addresses, titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions.cleaning import strip


def channel_handle(url: Column) -> Column:
    found = F.regexp_extract(url, fixed.CHANNEL_HANDLE, 1)
    return F.when(found == "", fixed.UNKNOWN_CHANNEL).otherwise(found)


def tab_url(url: Column, tab: str) -> Column:
    """Channel address of the ``videos`` or ``shorts`` tab."""
    if tab not in ("videos", "shorts"):
        raise ValueError("tab is 'videos' or 'shorts'")
    base = F.rtrim(url, F.lit("/"))
    return F.when(F.endswith(base, F.lit(f"/{tab}")), base).otherwise(
        F.concat(base, F.lit(f"/{tab}"))
    )


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit(fixed.WATCH_PREFIX), video_id)


def video_id(url: Column) -> Column:
    """What follows the first ``watch?v=``, else the end of the address."""
    mark = "watch?v="
    size = fixed.VIDEO_ID_CHARS
    after = F.substring(F.split_part(url, F.lit(mark), F.lit(2)), 1, size)
    return F.when(F.contains(url, F.lit(mark)), after).otherwise(F.right(url, F.lit(size)))


def clean_title(title: Column, fallback: Column) -> Column:
    """A title usable as a file name; ``fallback`` when nothing is left of it."""
    kept = F.regexp_replace(
        strip(F.coalesce(title, F.lit(""))), fixed.TITLE_FORBIDDEN, ""
    )
    return F.coalesce(F.nullif(F.substring(kept, 1, fixed.TITLE_CHARS), F.lit("")), fallback)
