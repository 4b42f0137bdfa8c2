"""P3. Reasoning-trace removal from generated text, line by line, JVM-side.

Semantics (GNU sed ranges, all case-insensitive), tested in this order for each
line; a deleting range ends that line's turn:

1. ``<think>`` ... ``</think>``
2. ``think...`` ... ``done thinking.``
3. ``thinking...`` ... ``done thinking.``

A range's end is looked for from the line *after* its start, so
``<think>x</think>`` on one line opens a range that runs to the next
``</think>`` (or to the end).  Each range has its own open flag; a line deleted
by range 1 is not seen by ranges 2 and 3.  Then lines that are only
``thinking`` and blank lines go, every line is trimmed, and runs of spaces are
squeezed.  Lines are joined with newline.

Plan: one regex pass for each range, in that order.  A range is a line with its
opening marker up to the first later line with its closing marker (or the end); a
line deleted by one pass is gone for the next.  The passes and the line filter are
linear in the text, whatever its number of lines or markers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range markers of the rule (matched case-insensitively).
OPEN_1, CLOSE_1 = r"<think>", r"</think>"
OPEN_2, CLOSE_2 = r"think\.\.\.", r"done thinking\."
OPEN_3, CLOSE_3 = r"thinking\.\.\.", r"done thinking\."
ONLY_THINKING = r"^\s*thinking\s*$"
BLANK = r"^\s*$"


def _range(opening: str, closing: str) -> str:
    """Whole lines from one with ``opening`` to the next later one with ``closing``."""
    return (rf"(?dims)^[^\n]*(?:{opening})[^\n]*"
            rf"(?:\n.*?(?:{closing})[^\n]*(?:\n|\z)|\n.*\z|\z)")


RANGES = [_range(OPEN_1, CLOSE_1), _range(OPEN_2, CLOSE_2), _range(OPEN_3, CLOSE_3)]


def _tidy(x: Column) -> Column:
    # sed: s/^[[:space:]]+//; s/[[:space:]]+$//   then tr -s ' '
    return F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), " {2,}", " ")


def strip_trace(c) -> Column:
    """P3 as a Column."""
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    for pattern in RANGES:
        text = F.regexp_replace(text, pattern, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike("(?i)" + ONLY_THINKING) & ~x.rlike(BLANK))
    return F.array_join(F.transform(lines, _tidy), "\n")
