"""Financial ratios and score maps as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column


def ratio(name: str) -> Column:
    """One of ``schema.RATIOS``; a zero denominator gives null."""
    above, below = S.RATIOS[name]
    return F.try_divide(reduce(add, map(column, above)), reduce(add, map(column, below)))


def score(name: str, mapping: Mapping[str, int], default: int | None = None) -> Column:
    """Map the words of a column to points; other words and null get ``default``."""
    words = iter(mapping.items())
    word, points = next(words)
    chain = F.when(column(name) == word, points)
    for word, points in words:
        chain = chain.when(column(name) == word, points)
    return chain.otherwise(F.lit(default).cast("int"))


def rating_score(name: str = "CR_Rating") -> Column:
    return score(name, S.RATING_SCORES)


def discipline_score(name: str = "pmt_discipline", strict: bool = False) -> Column:
    if strict:
        return score(name, S.DISCIPLINE_STRICT)
    return score(name, S.DISCIPLINE_LENIENT, S.DISCIPLINE_LENIENT_DEFAULT)
