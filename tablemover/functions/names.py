"""Names and locations as columns: dotted names, back-tick quoting, flag-driven storage roots."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(*parts) -> Column:
    """``a.b.c`` from name parts (columns or column names); null parts are skipped."""
    return F.concat_ws(".", *[_c(p) for p in parts])


def quote_ident(part) -> Column:
    """Back-tick quote one name part, doubling any back-tick inside it."""
    return F.concat(F.lit("`"), F.replace(_c(part), F.lit("`"), F.lit("``")), F.lit("`"))


def quoted_full_name(*parts) -> Column:
    return F.concat_ws(".", *[quote_ident(p) for p in parts])


def location_for(is_pii, pii_root: str, nonpii_root: str, *parts) -> Column:
    """``root/part/part``; the PII root when the flag is true *or unknown* (the safe side). Null
    when a part is missing, so two tables can never be given one location by a skipped part."""
    root = F.when(_c(is_pii) == F.lit(False), F.lit(nonpii_root.rstrip("/"))).otherwise(
        F.lit(pii_root.rstrip("/")))
    pieces = [root]
    for p in parts:
        pieces += [F.lit("/"), _c(p)]
    return F.concat(*pieces)
