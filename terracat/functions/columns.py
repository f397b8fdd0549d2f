"""Column -> Column helpers (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the catalog's own definitions for equal results).
#
# Identifier normaliser: lower-case, every character that is not a letter,
# digit or underscore becomes "_", then leading/trailing underscores are
# removed and runs of underscores collapse to one.
NON_WORD_PATTERN = r"[^\p{L}\p{N}_]"
EDGE_OR_REPEATED_UNDERSCORE_PATTERN = r"^_+|_+$|_(?=_)"
# Validity period given to promoted metadata concepts.
METADATA_VALID_START = "1970-01-01"
METADATA_VALID_END = "2099-12-31"
# Locally minted concept ids are strictly greater than this.
MINTED_ID_THRESHOLD = 2_000_000_000
# Plain decimal / scientific number text (guards try_cast against forms such
# as "1D" or "0x1p3" that Java would otherwise read as numbers).
NUMERIC_TEXT_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_concat(*cols) -> Column:
    """``concat`` where a NULL argument counts as the empty string."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


# Java lower-cases two characters differently from a per-character mapping:
# capital I with dot above becomes "i" plus a combining dot, and a
# word-final capital sigma becomes a final sigma.  Mapping them first makes
# ``lower`` per-character, as in the database and DuckDB.
_PER_CHAR_LOWER_FROM = "\u0130\u03a3"
_PER_CHAR_LOWER_TO = "i\u03c3"


def per_char_lower(c) -> Column:
    """Lower case, one character at a time (no context-dependent rules).
    The mapping pass runs only on values holding one of the two characters
    (a byte search), so whole texts without them pay nothing extra."""
    c = _col(c)
    special = c.contains(_PER_CHAR_LOWER_FROM[0]) | c.contains(_PER_CHAR_LOWER_FROM[1])
    return F.lower(F.when(special, F.translate(c, _PER_CHAR_LOWER_FROM, _PER_CHAR_LOWER_TO)).otherwise(c))


def slug(c) -> Column:
    """Normalise an identifier for use as a schema or table name."""
    lowered = per_char_lower(c)
    word = F.regexp_replace(lowered, NON_WORD_PATTERN, "_")
    return F.regexp_replace(word, EDGE_OR_REPEATED_UNDERSCORE_PATTERN, "")


def joined_description(*cols, sep: str = " ") -> Column:
    """``concat_ws``: NULL arguments are skipped, separators not doubled."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def left(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_col(c), 1, n)


def date_lit(text: str) -> Column:
    return F.lit(text).cast("date")


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def id_text(c) -> Column:
    """Decimal text of an integer id (the text lookup key of a concept)."""
    return _col(c).cast("long").cast("string")


def is_numeric_text(c) -> Column:
    return _col(c).rlike(NUMERIC_TEXT_PATTERN)


def parse_number(c) -> Column:
    """Guarded numeric parse: a double for plain number text, else NULL."""
    return F.when(is_numeric_text(c), F.trim(_col(c)).try_cast("double"))


def non_blank(c) -> Column:
    """``c <> '' AND c IS NOT NULL``."""
    return (_col(c) != F.lit("")) & _col(c).isNotNull()


def covers(start, end, on) -> Column:
    """Inclusive period test ``start <= on <= end``."""
    on_c = on if isinstance(on, Column) else F.lit(on).cast("date")
    return (_col(start) <= on_c) & (on_c <= _col(end))
