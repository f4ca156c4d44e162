"""Small column expressions shared by the ranking stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params

# Fixed values of the priority ladder (lower wins).  The base is the candidate
# source, and an item that is on promotion moves four places down:
#   order association 1, rule log 2, same-category best-seller 3,
#   parent-category best-seller 4; promoted items 5, 6, 7, 8.
ORDER_ASSOC, RULE_LOG, SAME_CATEGORY, PARENT_CATEGORY = 1, 2, 3, 4
PROMOTED_OFFSET = 4
# Importance given to every best-seller candidate.
CATEGORY_IMPORTANCE = "0"
# Separator of the recommendation lists.
LIST_SEP = ","


def discount_code(base: Column | int, promotype: Column) -> Column:
    """``base`` for an item off promotion (promotype 1), ``base + 4`` when promoted."""
    b = base if isinstance(base, Column) else F.lit(base)
    return (b + F.lit(PROMOTED_OFFSET) * (F.lit(1) - promotype)).cast("int")


def importance_key(col: Column | str, params: Params) -> Column:
    """Sort key of an importance string.

    Text order is the parity default ('9' sorts above '10' descending);
    ``importance_order="numeric"`` compares the parsed number instead.
    """
    c = F.col(col) if isinstance(col, str) else col
    if params.importance_order == "numeric":
        # try_cast: text that is not a number sorts as NULL instead of failing
        # under ANSI mode (the Spark 4 default).
        return c.try_cast("double")
    return c


def falling(col: Column, params: Params) -> Column:
    """A key that sorts upwards as ``importance_key`` sorts downwards, nulls last.

    So entries of an array come in (code, importance desc, item) order by their natural one.
    """
    key = importance_key(col, params)
    if params.importance_order == "numeric":
        return F.struct(key.isNull().alias("none"), (~F.isnan(key)).alias("number"), (-key).alias("value"))
    return falling_text(key)


def falling_text(text: Column) -> Column:
    """Upwards by this string is downwards by the bytes of ``text``, nulls last."""
    # Hexadecimal digits are turned round; what goes on sorts before what ends (G), null after all.
    turned = F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.coalesce(F.concat(turned, F.lit("G")), F.lit("H"))


def ordered_list(item: str, *order: str) -> Column:
    """Comma-joined ``item`` values of a group in the given SQL order."""
    keys = ", ".join(order)
    # Items of any collation are listed as they are spelled.
    return F.expr(f"listagg(collate({item}, 'UTF8_BINARY'), '{LIST_SEP}') WITHIN GROUP (ORDER BY {keys})")
