"""String keys, code lists and dummies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The coupon count codes the features know.
COUNT_CODES = ["27", "02|25", "60", "4", "1", "58", "11", "16|34", "56", "37", "44", "9", "10"]


def composite_key(*cols: str) -> Column:
    return F.concat_ws("_", *cols)


def padded(c, width: int) -> Column:
    """A number as text with leading zeros; longer ones stay whole, where lpad alone would cut them."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def key_part(col: str, position: int) -> Column:
    """1-based part of a composite key; NULL when the key has fewer parts."""
    return F.try_element_at(F.split(F.col(col), "_"), F.lit(position))


def code_list(col) -> Column:
    """Distinct codes of a group, sorted, comma-joined; NULL for a group without codes."""
    codes = F.sort_array(F.collect_set(col))
    return F.when(F.size(codes) > 0, F.array_join(codes, ","))


def has_code(codes: str, code: str, exact: bool = False) -> Column:
    """1 when ``code`` occurs in a comma-joined list, else 0 (also for NULL).

    By default any substring counts, so MP is found in MPM and 1 in 11; ``exact`` compares
    whole list entries.
    """
    hit = (F.array_contains(F.split(F.col(codes), ","), code) if exact
           else F.instr(F.col(codes), code) >= 1)
    return F.when(hit, 1).otherwise(0)


def has_none_of(codes: str, known: list[str], exact: bool = False) -> Column:
    """1 when the list is not NULL and holds none of the known codes."""
    if exact:
        miss = ~F.arrays_overlap(F.split(F.col(codes), ","), F.array(*[F.lit(k) for k in known]))
    else:
        miss = F.lit(True)
        for code in known:
            miss = miss & (F.instr(F.col(codes), code) == 0)
    return F.when(F.col(codes).isNotNull() & miss, 1).otherwise(0)
