"""Text-to-value helpers. Missing is always SQL NULL, never NaN."""

from pyspark.sql import Column, functions as F

from chondria.schema import NA_TOKENS


def text_or_null(c: Column) -> Column:
    """NULL for the tokens that string tables use for a missing value."""
    return F.when(c.isin(NA_TOKENS), None).otherwise(c)


def number(c: Column) -> Column:
    """Double, or NULL when the text is no finite-or-infinite number (``NaN`` counts as missing)."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def integer(c: Column) -> Column:
    return c.try_cast("int")


def if_known(cond: Column, then, otherwise) -> Column:
    """Conditional that is NULL, not ``otherwise``, when the condition is NULL."""
    return F.when(cond, then).when(~cond, otherwise)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
