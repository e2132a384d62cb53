"""Text to typed values. Dirty text becomes null, never an error.

The functions take the SQL text of their input and give SQL text: one
expression then costs one call into the JVM, and plans stay readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Accepted spellings.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
# The same without its separators, or with another sign between date and time.
LOOSE_TIMESTAMP = (
    r"^(\d{4})-?(\d{2})-?(\d{2})(?:\D(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(?:Z|([+-]\d{2})(?::?(\d{2}))?)?)?$"
)
REFERENCE_RANGE = r"^\s*(-?\d+(?:\.\d+)?)\s*-\s*(-?\d+(?:\.\d+)?)\s*$"


def text_id(value: str) -> str:
    """Ids are text; the empty text counts as missing."""
    return f"nullif(CAST({value} AS STRING), '')"


def to_number(value: str) -> str:
    """Number or null. Spark also reads ``1.0f`` and ``1.0d``; those are refused.

    The last character tells cheaply which values need the pattern at all.
    """
    suspect = f"instr('fFdD \\t\\r\\n', right({value}, 1)) > 0"
    suffixed = f"{value} RLIKE r'[0-9.][fFdD]\\s*$'"
    return f"CASE WHEN NOT ({suspect} AND {suffixed}) THEN try_cast({value} AS DOUBLE) END"


def to_instant(value: str) -> str:
    """ISO date-time to timestamp; without an offset it is UTC (session zone).

    Spark reads an offset only with its colon, so ``+0530`` becomes ``+05:30`` first. Basic
    forms (``20270101T003000Z``) and other signs than T between date and time are put together
    from their parts, which only costs where the common form does not fit.
    """
    bare = f"{value} RLIKE r'[0-9][+-][0-9]{{4}}$'"
    offset = f"concat(left({value}, length({value}) - 2), ':', right({value}, 2))"
    common = f"try_to_timestamp(CASE WHEN {bare} THEN {offset} ELSE {value} END)"

    def part(group: int, missing: str) -> str:
        return f"coalesce(nullif(regexp_extract({value}, r'{LOOSE_TIMESTAMP}', {group}), ''), '{missing}')"

    pieces = [part(1, ""), "'-'", part(2, ""), "'-'", part(3, ""), "'T'", part(4, "00"), "':'", part(5, "00"), "':'", part(6, "00")]
    pieces += ["'.'", f"left({part(7, '0')}, 6)", part(8, "+00"), "':'", part(9, "00")]
    loose = f"try_to_timestamp(concat({', '.join(pieces)}))"
    return f"CASE WHEN {value} RLIKE r'{ISO_TIMESTAMP}' THEN {common} WHEN {value} RLIKE r'{LOOSE_TIMESTAMP}' THEN {loose} END"


def reference_low(value: str) -> str:
    return f"try_cast(nullif(regexp_extract({value}, r'{REFERENCE_RANGE}', 1), '') AS DOUBLE)"


def reference_high(value: str) -> str:
    return f"try_cast(nullif(regexp_extract({value}, r'{REFERENCE_RANGE}', 2), '') AS DOUBLE)"


def finite(value: str) -> str:
    """The value, or null when it is NaN or infinite."""
    return f"CASE WHEN NOT isnan({value}) AND abs({value}) < CAST('Infinity' AS DOUBLE) THEN {value} END"


def parse_once(rows: DataFrame, parsed: dict[str, str]) -> DataFrame:
    """Replace or add columns such that each is computed once per row.

    Spark pushes a filter below a projection and so repeats the projection's
    expressions in the filter; a JSON or regex step is then paid again for every
    condition. ``inline`` of one struct gives the same rows, and filters stay above it.
    """
    fields = ", ".join(f"{sql} AS `{name}`" for name, sql in parsed.items())
    kept = [c for c in rows.columns if c not in parsed]
    wide = rows.select(*kept, F.expr(f"inline(array(struct({fields})))"))
    return wide.select(*rows.columns, *[c for c in parsed if c not in rows.columns])
