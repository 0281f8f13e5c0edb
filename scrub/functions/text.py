"""String cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TO_THE_END = 2147483647


def trim_spaces(c: Column) -> Column:
    """Cut spaces (and only spaces) off both ends."""
    return F.trim(c)


def collapse_whitespace(c: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(c, r" \s+|[^\S ]\s*", " ")


def title_case(c: Column) -> Column:
    """Lower-case the text, then upper-case the first character of every word.

    ``initcap`` only starts words after a space; here a word starts at any word boundary.
    """
    pieces = F.split(F.lower(c), r"(?U)\b")
    return F.array_join(
        F.transform(
            pieces,
            lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, TO_THE_END)),
        ),
        "",
    )


def keep_alphanumeric(c: Column) -> Column:
    """Delete everything but ASCII letters, digits and white space."""
    return F.regexp_replace(c, r"[^a-zA-Z0-9\s]+", "")


CASES = {"none": lambda c: c, "lower": F.lower, "upper": F.upper, "title": title_case}
