"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of letters and digits, or a run of anything else.
WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def blank_to_null(column: str) -> Column:
    """The empty string means "no value"."""
    return F.nullif(F.col(column), F.lit(""))


def title_words(text: Column) -> Column:
    """Upper-case the first character of every alphanumeric run.

    Spark's own ``initcap`` only starts a word after white space, so a hyphen or an
    apostrophe would swallow the next capital.
    """
    runs = F.regexp_extract_all(text, F.lit(WORD_OR_GAP), F.lit(1))
    titled = F.transform(
        runs,
        lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substr(run, F.lit(2)))),
    )
    return F.array_join(titled, "")


def clean_city(column: str) -> Column:
    return title_words(F.trim(F.col(column)))


def clean_state(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))
