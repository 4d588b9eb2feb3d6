"""Safe arithmetic: ANSI mode raises on x/0 and on bad casts, so both are explicit here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are summed as whole ten-thousandths: exact, independent of task order, and plain
# long additions inside generated code where decimals would allocate an object per row.
UNITS = 10000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """An amount cleaned to four decimals."""
    return F.rint(_col(c) * UNITS) / UNITS


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def rounded(c, digits: int = 6) -> Column:
    return F.round(_col(c).cast("double"), digits)


def total(c) -> Column:
    """Exact sum of an amount column, as double."""
    return F.sum(F.rint(_col(c) * UNITS).cast("bigint")) / UNITS


def mean_money(c) -> Column:
    """Mean from the exact sum and the count of non-null values."""
    return ratio(total(c), F.count(_col(c)))


def exact_mean(c, over=None) -> Column:
    """Mean of a double column whose value does not depend on the order rows are added in."""
    col = _col(c)
    num, den = F.sum(col.cast("decimal(24,8)")), F.count(col)
    if over is not None:
        num, den = num.over(over), den.over(over)
    return ratio(num, den)


def zero(c) -> Column:
    return F.coalesce(_col(c), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 / 0 integer flag; NULL conditions count as 0."""
    return F.when(condition, 1).otherwise(0)
