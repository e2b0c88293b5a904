"""Target text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label words of the source tables.
POSITIVE = "SIM"
NEGATIVE = ("NAO", "NÃO")

UNKNOWN_RULES = ("null", "zero", "minus_one", "error")


def encode_label(label: Column | str, unknown: str = "null", exact: bool = False) -> Column:
    """1.0 for the positive word, 0.0 for the negative ones.

    ``unknown`` says what any other value, null included, becomes. With
    ``exact`` case matters and only the accented negative word counts.
    """
    if unknown not in UNKNOWN_RULES:
        raise ValueError(f"unknown must be one of {UNKNOWN_RULES}")
    text = F.col(label) if isinstance(label, str) else label
    if exact:
        code = F.when(text == POSITIVE, 1.0).when(text == NEGATIVE[1], 0.0)
    else:
        upper = F.upper(text)
        code = F.when(upper == POSITIVE, 1.0).when(upper.isin(*NEGATIVE), 0.0)
    if unknown == "zero":
        return F.coalesce(code, F.lit(0.0))
    if unknown == "minus_one":
        return F.coalesce(code, F.lit(-1.0))
    if unknown == "error":
        problem = F.concat(F.lit("unknown label: "), F.coalesce(text.cast("string"), F.lit("null")))
        return F.coalesce(code, F.raise_error(problem).cast("double"))
    return code


def target_class(word: str) -> float:
    """Class a label word stands for: the positive word is 1, all others 0."""
    return 1.0 if word.upper() == POSITIVE else 0.0
