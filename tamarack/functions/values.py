"""Single values out of dirty fields, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands in a name field when nobody knew the name.
FILLERS = frozenset(
    ["", "n/a", "na", "n.a.", "none", "null", "nil", "unknown", "tbd", "tba", "test", "xxxx", "xxx", "(blank)", "blank", "see notes", "no name given",
     "company name", "not disclosed", "coming soon", "same as above", "see directory", "not available", "not provided", "no website", "www", "http://",
     "https://", "http", "https", "?", "??", "???", "-", "--", "---", "."]
)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it; keeps long expressions small."""
    return F.get(F.transform(F.array(value), body), 0)


def real_text(c: Column) -> Column:
    """The trimmed text; null where it is blank or one of the fillers."""
    text = F.trim(F.regexp_replace(c, "\\s+", " "))
    return F.when(~F.lower(text).isin(*sorted(FILLERS)), text)


def head_count(c: Column, most: int = 2_500_000) -> Column:
    """Employees out of a typed figure, as bigint: ranges give their middle (half to even), "~" and words beside it are ignored.

    Null for figures that count nobody: none, negative, zero, above ``most``, and runs of four or more nines.
    """
    text = F.regexp_replace(F.trim(c), ",(?=\\d{3})", "")
    span = "^\\D{0,12}?(\\d+)(?:\\.\\d+)?\\s*(?:-|–|to)\\s*(\\d+)"
    low, high = F.regexp_extract(text, span, 1), F.regexp_extract(text, span, 2)
    one = F.regexp_extract(text, "(\\d+(?:\\.\\d+)?)", 1)
    middle = F.bround((low.try_cast("double") + high.try_cast("double")) / 2)
    value = F.when(low != "", middle).otherwise(one.try_cast("double"))
    bad = text.rlike("^\\s*-\\s*\\d") | one.rlike("^9{4,}(\\.0*)?$") | (value <= 0) | (value > most) | value.isNull()
    return F.when(~bad, value.cast("bigint"))


def payload_field(payload: Column, name: str) -> Column:
    """A field of a JSON payload as text, whatever its JSON type; null where absent, null or not parsable."""
    return F.get_json_object(payload, f"$.{name}")


def source_label(c: Column) -> Column:
    """A source's name without differences of case, padding and separators; blank gives null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(c)), "[\\s-]+", "_"), F.lit(""))
