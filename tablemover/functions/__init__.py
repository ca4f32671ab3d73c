"""Column expressions shared by the operators; all built-in Spark functions."""

from .names import full_name, location_for, quote_ident, quoted_full_name
from .timefmt import mm_ss
from .checksum import canonical_text, row_digest, row_hash

__all__ = ["full_name", "location_for", "quote_ident", "quoted_full_name", "mm_ss",
           "canonical_text", "row_digest", "row_hash"]
