r"""A lossless split of SQL text into tokens, for rewriting table references.

Each match of ``SQL_TOKEN`` is one token; the tokens of a text joined back together are the text.
Loops are unrolled and possessive: the matcher neither recurses per character nor backtracks, so a
literal of any length passes. Alternatives, tried in order:

* a single-quoted string literal (doubled quote or backslash escape inside),
* a double-quoted string literal,
* a ``--`` line comment, a ``/* */`` block comment,
* a dotted identifier: parts are back-ticked names or word characters, joined by dots,
* a run of other characters, or any single character.

``\w`` is Unicode-aware (``(?U)``), so a name with non-ASCII letters is one word.

Only dotted identifiers are candidates for rewriting, so names inside literals and comments stay
as they are, ``my_hive_metastore_z`` is one word, and ``db.ab`` is never a hit for ``db.a``.
"""

# The token pattern (Java regex, used by regexp_extract_all) and the pattern of one
# part of a dotted name.
SQL_TOKEN = (r"(?sU)('[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
             r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
             r"|--[^\n]*+"
             r"|/\*[^*]*+(?:\*(?!/)[^*]*+)*+\*/"
             r"|(?:`[^`]+`|\w++)(?:\.(?:`[^`]+`|\w++))*+"
             r"|[^\w`'\"/-]++"
             r"|.)")
NAME_PART = r"(?U)(`[^`]+`|\w+)"
IDENT_TOKEN = r"(?U)^(?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))*$"
