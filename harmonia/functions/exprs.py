"""Column-expression helpers (all JVM-side, codegen friendly).

R and Spark differ mostly in NULL handling; these helpers spell out the R
behaviour the operators need so that call sites stay short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def C(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- aggregates ------------------------------------------------------------

def sum_strict(x) -> Column:
    """R ``sum(x)`` without ``na.rm``: NULL as soon as one input is NULL."""
    x = C(x)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


# --- numbers ---------------------------------------------------------------

def signif(x, digits: int = 4) -> Column:
    """R ``signif``: round to ``digits`` significant digits (half away from 0).

    Scale by an exact power of ten (multiply for small numbers, divide for
    large ones) so the arithmetic is reproducible in any SQL engine.
    """
    x = C(x)
    k = (F.floor(F.log10(F.abs(x))) - F.lit(digits - 1)).cast("int")
    up = F.pow(F.lit(10.0), -k)
    down = F.pow(F.lit(10.0), k)
    return (F.when(x.isNull(), None)
            .when(x == 0, F.lit(0.0))
            .when(k < 0, F.round(x * up) / up)
            .otherwise(F.round(x / down) * down))


def row_mean(cols) -> Column:
    """Mean of the non-NULL values among ``cols`` (R ``rowMeans(na.rm=TRUE)``);
    NULL when all are NULL (R gives NaN)."""
    arr = F.filter(F.array(*[C(c).cast("double") for c in cols]), lambda v: v.isNotNull())
    total = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(arr) > 0, total / F.size(arr))


# --- strings ---------------------------------------------------------------

def squish(x) -> Column:
    """``str_squish``: trim all whitespace, collapse inner runs to one space."""
    return F.regexp_replace(F.regexp_replace(C(x), r"^\s+|\s+$", ""), r"\s+", " ")


def r_paste_value(x) -> Column:
    """How R ``paste`` prints a value: NULL becomes the text ``NA``."""
    return F.coalesce(C(x).cast("string"), F.lit("NA"))


# Latin letters with diacritics and their ASCII base letter,
# used for ASCII folding ("iconv ... ASCII//TRANSLIT" in the reference).
FOLD_FROM = "ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖØòóôõöøÙÚÛÜùúûüÝýÿ"
FOLD_TO = "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOOooooooUUUUuuuuYyy"


def ascii_fold(x) -> Column:
    return F.translate(C(x), FOLD_FROM, FOLD_TO)


def any_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def all_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
