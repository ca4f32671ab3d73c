"""Durations as ``MM:SS`` text: zero padded, minutes unbounded, seconds truncated."""

from pyspark.sql import Column, functions as F

# Fixed value: the elapsed-time text format, minutes and seconds each zero-padded to two digits.
MM_SS_FORMAT = "%02d:%02d"


def mm_ss(seconds) -> Column:
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    whole = F.floor(s).cast("long")
    return F.format_string(MM_SS_FORMAT, F.floor(whole / 60).cast("long"), F.pmod(whole, F.lit(60)))
