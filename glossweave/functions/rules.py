"""Translation rules as a text column: compact form for the prompt and a stable id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossweave.functions.text import strip

# Limit, truncation mark and the constraints that close every prompt.
RULES_LIMIT = 2500
TRUNCATION_MARK = "\n[TRUNCATED_RULES]"
CONSTRAINTS = (
    "\n\nConstraints:\n"
    "- Keep meaning faithful.\n"
    "- Do not invent content.\n"
    "- Preserve letters A/B/C/D/E and formatting as much as possible.\n"
    "- Keep numbers, units, codes unchanged.\n"
)
# Every line boundary of the Unicode line-splitting rule.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def compact_rules(text: Column, limit: int | None = None) -> Column:
    """Stripped lines that are not blank, uncut unless a limit such as ``RULES_LIMIT`` is given, and the constraints."""
    lines = F.filter(F.transform(F.split(text, LINE_BREAK), strip), lambda line: line != "")
    short = F.array_join(lines, "\n")
    if limit is None:
        return F.concat(short, F.lit(CONSTRAINTS))
    cut = F.when(F.length(short) > limit, F.concat(F.left(short, F.lit(limit)), F.lit(TRUNCATION_MARK)))
    return F.concat(F.coalesce(cut, short), F.lit(CONSTRAINTS))


def rules_id(text: Column) -> Column:
    """First 16 hex digits over the full rule text, so that any edit starts a new memory generation."""
    return F.left(F.sha2(text, 256), F.lit(16))
