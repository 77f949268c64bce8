"""Scalar functions over the raw observation documents (VARIANT) and their text.

All are built-in Column expressions: they stay JVM-side inside whole-stage
codegen, and ``try_variant_get`` paths are pushed into the Parquet scan of a
VARIANT column, so only the extracted fields are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit prefix removed from unit codes, and the numeric
# literal forms accepted by the safe cast to double (decimal or exponent
# notation, or inf / infinity / nan, with an optional sign, case-insensitive).
UNIT_PREFIX = "wmoUnit:"
NUMERIC_LITERAL = r"(?i)^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([e][+-]?[0-9]+)?|inf|infinity|nan)$"
# Canonical timestamp text: a full date, optionally a time (seconds and
# fraction optional), optionally Z / UTC / a +HH[:MM] offset / a named zone
# (``Area/City``; the cast rejects names that no zone has).
TIMESTAMP_TEXT = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"([T ][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,9})?)?)?"
    r" ?(Z|z|UTC|[+-][0-9]{1,2}(:?[0-9]{2})?|[A-Za-z]+(/[A-Za-z0-9_+-]+){1,2})?$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(path: str) -> str:
    """Accept ``a.b[0]`` or ``$.a.b[0]``."""
    return path if path.startswith("$") else "$." + path


def json_value(doc, path: str) -> Column:
    """Scalar at ``path`` of a VARIANT document as text.

    NULL when the path is missing, holds a JSON null, or holds an object or an
    array (only scalars are returned). Numbers and booleans come back as their
    text. Keys are case-sensitive.
    """
    doc = _col(doc)
    # One sub-value per path: with a stored VARIANT column this extraction is
    # pushed into the Parquet scan (only that path is read).
    sub = F.try_variant_get(doc, json_path(path), "variant")
    text = F.try_variant_get(sub, "$", "string")
    # Objects and arrays also cast to (JSON) text, which starts with '{' or '['.
    # Only for such text look at the value's type, so scalar rows never pay it.
    kind = F.schema_of_variant(sub)
    container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    maybe_container = text.startswith("{") | text.startswith("[")
    return F.when(maybe_container & container, F.lit(None).cast("string")).otherwise(text)


def safe_double(text) -> Column:
    """Text -> double, NULL for anything that is not a numeric literal.

    Guards Spark's lenient cast (which also takes ``1.5d``, hex floats and
    surrounding blanks) with a literal pattern; booleans, empty strings and
    words give NULL.
    """
    text = _col(text)
    return F.when(text.rlike(NUMERIC_LITERAL), text.try_cast("double"))


def iso_timestamp(text, on_bad: str = "fail") -> Column:
    """ISO-8601 text (offset allowed) -> TIMESTAMP.

    Text must have the canonical shape (see ``TIMESTAMP_TEXT``): Spark's own
    cast would also take a bare year such as ``'2026'``.

    ``on_bad="fail"`` raises on malformed non-NULL text (independent of the
    session's ANSI flag); ``on_bad="null"`` returns NULL instead.
    """
    text = _col(text)
    ts = F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp"))
    if on_bad == "null":
        return ts
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', got {on_bad!r}")
    return F.when(
        text.isNotNull() & ts.isNull(),
        F.raise_error(F.concat(F.lit("malformed timestamp: "), text)),
    ).otherwise(ts)


def strip_unit(text) -> Column:
    """Remove every ``wmoUnit:`` occurrence; NULL stays NULL."""
    return F.replace(_col(text), F.lit(UNIT_PREFIX), F.lit(""))
