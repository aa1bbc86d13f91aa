"""Scalar expressions as SQL text: casts, dates, buckets and display text.

Each function takes and returns SQL, for ``selectExpr`` and ``expr``. A select list
given as text reaches the JVM in one call, where the same list built from Column
objects takes a call per operator.
"""

from __future__ import annotations

from datetime import date

from tripartite.schemas import MONEY_TOTAL

# A calendar day, optionally followed by a time of day and its zone, which do not count.
_DAY_TEXT = "^([0-9]{4,}-[0-9]{1,2}-[0-9]{1,2})([ T][0-9]{1,2}:[0-9:.]+( ?(Z|UTC|[+-][0-9:]+))?)?$"
# Slashes, backslashes or spaces instead of hyphens, the same one twice. A backslash
# stands for itself in a regular expression, and for itself again in SQL text.
_OTHER_MARKS = "^([0-9]+)([/ ]|\\\\\\\\)([0-9]+)\\\\2([0-9]+)"

# Last day and label of each age bucket.
AGING_BUCKETS = [(7, "0-7 days"), (30, "8-30 days"), (60, "31-60 days")]
OLDEST_BUCKET = "60+ days"


def day(value: date) -> str:
    return f"date'{value.isoformat()}'"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def money_total(amount: str) -> str:
    return f"cast({amount} as {MONEY_TOTAL})"


def parse_date(dirty: str) -> str:
    """Date from dirty text; null where the text is no full calendar day.

    ``try_cast`` alone would read the bare year ``2025`` as 1 January, which
    turns an unpaid sale into a paid one, so the shape is checked first.
    """
    marked = f"regexp_replace(trim({dirty}), '{_OTHER_MARKS}', '$1-$3-$4')"
    cleaned = f"regexp_extract({marked}, '{_DAY_TEXT}', 1)"
    # The usual shape is told apart without a regular expression.
    usual = f"length({dirty}) = 10 and substr({dirty}, 5, 1) = '-' and substr({dirty}, 8, 1) = '-'"
    # Text of no known shape is cleaned to nothing, which is no date either.
    return f"try_cast(if({usual}, {dirty}, {cleaned}) as date)"


def strict_date(given: str) -> str:
    """Date of a column that is never dirty: text that is no full day raises an error,
    where a cast alone would read ``2025`` or ``2025-01`` as the first of January."""
    message = f"concat('not a calendar day: ', {given})"
    wrong = f"if({given} is null, null, raise_error({message}))"
    return f"coalesce({parse_date(given)}, cast({wrong} as date))"


def days_between(start: str, end: str) -> str:
    """Whole days from ``start`` to ``end``; negative when ``end`` is earlier."""
    return f"datediff({end}, {start})"


def holds(condition: str) -> str:
    """Two-valued truth of a condition: a null comparison counts as false."""
    return f"coalesce({condition}, false)"


def describe(pattern: str, *values: str) -> str:
    """``pattern`` with its {} filled in; null when one of the values is null."""
    pieces = pattern.split("{}")
    parts = [text(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts.append(f"cast({value} as string)")
        if piece:
            parts.append(text(piece))
    return f"concat({', '.join(parts)})"


def aging_bucket(days: str) -> str:
    upto = " ".join(f"when {days} <= {last} then {text(label)}" for last, label in AGING_BUCKETS)
    return f"case {upto} else {text(OLDEST_BUCKET)} end"


def severity_rank(severity: str) -> str:
    return f"case {severity} when 'high' then 1 when 'medium' then 2 else 3 end"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """Rounded quotient, 0 where the denominator is 0."""
    quotient = f"round(double({numerator}) / double({denominator}), {digits})"
    return f"if({denominator} = 0, 0d, {quotient})"


def percent_text(part: str, whole: str) -> str:
    """``part`` of ``whole`` as a whole percentage (half to even), or N/A."""
    percent = f"bround(double({part}) / double({whole}) * 100, 0)"
    return f"if({whole} = 0, 'N/A', concat(cast(bigint({percent}) as string), '%'))"
