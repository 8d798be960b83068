"""String to value casts that never raise and do not depend on the session.

Spark 4 runs in ANSI mode by default, where a plain cast of a bad string
raises. A landing file needs the opposite: a bad value is a finding about the
row. ``int_lenient`` gives the answer of the classic (non-ANSI) cast whatever
``spark.sql.ansi.enabled`` says; ``int_strict`` is ``try_cast``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the classic cast accepts around and inside an integer. ``\z`` is the
# very end; ``$`` would also match before a line terminator.
BLANKS = r"[\x00-\x20\x7f]*"
INT_SHAPE = rf"^{BLANKS}[+-]?[0-9]*(\.[0-9]*)?{BLANKS}\z"
INT_DIGITS = rf"^{BLANKS}([+-]?[0-9]+)"
INT_CONTENT = r"[0-9.]"
INT_TYPES = ("tinyint", "smallint", "int", "bigint")

# How a value of each type has to look, so that the cast keeps all of it. Blanks around it are no part of it.
DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIME = rf"{DAY}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\.[0-9]{{1,6}})?"
UTC = r"(Z|UTC|GMT|[+-]00:?00)"
SHAPES = {
    "date": DAY,
    "timestamp_ntz": rf"({DAY}|{TIME}( ?{UTC})?)",
    # Without an offset the value would depend on the session's time zone.
    "timestamp": rf"{TIME} ?({UTC}|[+-][0-9]{{2}}:?[0-9]{{2}})",
    "double": r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?",
}
SHAPES["float"] = SHAPES["double"]


def _shape(data_type: str) -> str | None:
    found = re.fullmatch(r"(?:decimal|numeric|dec)(?:\(\s*\d+\s*(?:,\s*(\d+)\s*)?\))?", data_type.lower())
    if found:
        # More digits than the scale keeps may only be zeros.
        return rf"[+-]?([0-9]+(\.[0-9]{{0,{found[1] or 0}}}0*)?|\.[0-9]{{1,{found[1] or 1}}}0*)"
    return SHAPES.get(data_type.lower())


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def int_strict(column: str, data_type: str = "int") -> Column:
    """``try_cast`` to an integer type: whole numbers in its range, else null."""
    return F.expr(f"try_cast({quoted(column)} AS {data_type})")


def int_lenient(column: str, data_type: str = "int") -> Column:
    """The classic cast to an integer type: a fraction is cut off, a bad string is null.

    The strict cast answers for well-formed numbers; only the strings it
    refuses reach the patterns, so clean data pays for one parse.
    """
    c = quoted(column)
    return F.expr(
        f"""coalesce(
          try_cast({c} AS {data_type}),
          CASE WHEN {c} RLIKE r'{INT_SHAPE}' AND {c} RLIKE r'{INT_CONTENT}'
               THEN try_cast(
                 coalesce(nullif(regexp_extract({c}, r'{INT_DIGITS}', 1), ''), '0') AS {data_type})
          END)"""
    )


def int_cast(column: str, mode: str = "lenient", data_type: str = "int") -> Column:
    if mode == "lenient":
        return int_lenient(column, data_type)
    if mode == "strict":
        return int_strict(column, data_type)
    raise ValueError(f"unknown cast mode {mode!r}: use 'lenient' or 'strict'")


def typed_value(column: str, data_type: str, mode: str = "lenient") -> Column:
    """A landing string as a value of ``data_type``; null where it does not fit.

    All integer types are cast alike, each by its own range. The other types take a text only if
    nothing of it is lost: a date is a day and no more, a decimal has no digits beyond its scale, a
    double is finite, a ``timestamp`` names its offset, and a ``timestamp_ntz`` is a UTC time: another
    offset does not fit. The session's time zone does not matter.
    """
    if data_type == "string":
        return F.col(quoted(column))
    if data_type in INT_TYPES:
        return int_cast(column, mode, data_type)
    c = quoted(column)
    value, shape = f"try_cast({c} AS {data_type})", _shape(data_type)
    if shape:
        value = f"CASE WHEN CAST({c} AS STRING) RLIKE r'^{BLANKS}{shape}{BLANKS}\\z' THEN {value} END"
    if data_type.lower() in ("double", "float"):
        value = f"nullif(nullif({value}, CAST('Infinity' AS {data_type})), CAST('-Infinity' AS {data_type}))"
    return F.expr(value)
