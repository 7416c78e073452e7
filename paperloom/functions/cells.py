"""Numeric, boolean and significance expressions for result tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Cell texts that stand for a missing number.
MISSING = ("", "na", "nan", "n/a", "#n/a", "null", "none", "filtered", "inf", "-inf")
# Cell texts read as true and as false.
TRUE_CELLS = ("true", "t", "yes", "y", "1", "sig", "significant", "+")
FALSE_CELLS = ("false", "f", "no", "n", "0", "ns", "nonsig", "not_significant", "")


def _number(c: Column) -> Column:
    text = F.lower(strip(c))
    plain = F.regexp_replace(text, r"(?<=[0-9])_(?=[0-9])", "")
    shape = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"
    return (
        F.when(text.isin("infinity", "+infinity", "+inf"), F.lit(float("inf")))
        .when(text == "-infinity", F.lit(float("-inf")))
        .when(plain.rlike(shape), plain.try_cast("double"))
    )


def to_number(c: Column) -> Column:
    """Text cell as DOUBLE; missing-value words and unreadable text are NULL.

    ``try_cast`` alone accepts Java literals such as ``1d``, hence the shape test.
    """
    return F.when(~F.lower(strip(c)).isin(*MISSING), _number(c))


def optional_number(c: Column) -> Column:
    return to_number(c)


def to_bool(c: Column) -> Column:
    """Text cell as BOOLEAN; unknown words are NULL."""
    text = F.lower(strip(c))
    return F.when(text.isin(*TRUE_CELLS), True).when(text.isin(*FALSE_CELLS), False)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    value = c.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def sign(c: Column) -> Column:
    """1 or -1; zero, NULL and NaN are NULL."""
    return F.when(F.isnan(c), F.lit(None)).when(c > 0, 1).when(c < 0, -1)


def log_value(c: Column, base: float = 2.0, pseudocount: float = 0.0) -> Column:
    """Logarithm of ``c + pseudocount``; non-positive and non-finite values are NULL."""
    shifted = finite(c) + F.lit(float(pseudocount))
    return F.when(shifted > 0, F.log(float(base), shifted))


def is_significant(
    flag: Column,
    padj: Column,
    pvalue: Column,
    lfc: Column,
    alpha: float = 0.05,
    lfc_min: float = 0.0,
    use_padj: bool = True,
) -> Column:
    """The flag when present; else the chosen p-value against ``alpha`` and the fold change limit."""
    p = F.nanvl(pvalue, F.lit(None).cast("double"))
    q = F.nanvl(padj, F.lit(None).cast("double"))
    metric = F.coalesce(q, p) if use_padj else p
    passes = metric <= alpha
    if lfc_min > 0:
        passes = passes & (F.abs(F.nanvl(lfc, F.lit(None).cast("double"))) >= lfc_min)
    return F.coalesce(flag, passes, F.lit(False))


def coerce_score(c: Column) -> Column:
    """Model score clamped to [0, 1]; unreadable is NULL, NaN counts as 1."""
    value = strip(c.cast("string")).try_cast("double")
    # greatest() and least() skip NULLs, so an unreadable score is kept out of them.
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def coerce_flag(c: Column) -> Column:
    """Model flag given as text."""
    text = F.lower(strip(c.cast("string")))
    return F.when(text.isin("true", "yes", "y", "1"), True).when(text.isin("false", "no", "n", "0"), False)


def gate(score: Column, direct: Column, include: float = 0.7, exclude: float = 0.4) -> Column:
    """``error``, ``exclude``, ``include`` or ``flag``."""
    return (
        F.when(score.isNull(), "error")
        .when(score < exclude, "exclude")
        .when((score >= include) & F.coalesce(direct, F.lit(False)), "include")
        .otherwise("flag")
    )
