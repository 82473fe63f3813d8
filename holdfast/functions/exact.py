"""Arithmetic whose result does not depend on the order in which rows are added.

Money is summed as decimal. Ratios are taken once, on the finished sums, and are rounded
through a decimal so that a tie is decided by the printed digits and not by binary noise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DIGITS = 4
MONEY_TYPE = f"decimal(18,{MONEY_DIGITS})"
# Quantities, prices and usage as they enter a product or sum: eight decimals
FACTOR_TYPE = "decimal(18,8)"
_ROUNDING_TYPE = "decimal(28,10)"


def money(value: Column) -> Column:
    return value.cast(MONEY_TYPE)


def factor(value: Column) -> Column:
    """A quantity, price or usage with eight decimals; more integer digits than ten are an error."""
    return value.cast(FACTOR_TYPE)


# Units held, up to 10^12 with ten decimals; a product of units and a price with all its decimals
UNIT_TYPE = "decimal(22,10)"
PRODUCT_TYPE = "decimal(37,18)"


def product(units: Column, price: Column) -> Column:
    """units * price, exact to eighteen decimals; NULL where one of them does not fit its type.

    A product of both types at once would need 41 digits. The whole units and their fraction are
    multiplied apart, which needs 32 and 29, and added. A value that does not fit (too large, infinite, no
    number) costs its row the product and not the job: see :func:`unfit_factors`.
    """
    held, each = units.try_cast(UNIT_TYPE), price.try_cast(FACTOR_TYPE)
    whole = F.floor(held)
    return (whole * each).try_cast(PRODUCT_TYPE) + ((held - whole).cast("decimal(10,10)") * each).cast(PRODUCT_TYPE)


def unfit_factors(df, **kinds: str):
    """(column, cut, unfit) per column: how many values lose decimals in their type, and how many do not fit.

    ``kinds`` maps columns to the types in which they enter a product.
    """
    parts = []
    for column, kind in kinds.items():
        held = F.col(column).try_cast(kind)
        parts += [
            F.count_if(held.isNotNull() & (held.cast("double") != F.col(column).cast("double"))).alias(f"{column}.cut"),
            F.count_if(held.isNull() & F.col(column).isNotNull()).alias(f"{column}.unfit"),
        ]
    counted = df.agg(*parts)
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}.cut`").alias("cut"), F.col(f"`{c}.unfit`").alias("unfit")) for c in kinds]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def cut_factors(df, *columns: str):
    """Per column, how many rows hold more decimals than :func:`factor` keeps."""
    exact = "decimal(38,18)"
    return df.agg(
        *[
            F.count_if(F.col(c).cast(exact) != factor(F.col(c)).cast(exact)).alias(c)
            for c in columns
        ]
    )


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding of a double to ``digits`` places, as double.

    Where the value is clearly on one side of a tie, which is nearly always, the nearest whole number of the last place
    is the same; only the others become decimals one by one.
    """
    exact = F.round(value.cast(_ROUNDING_TYPE), digits).cast("double")
    if digits > 6:
        return exact
    scaled = value * F.lit(float(10**digits))
    nearest = F.rint(scaled)
    clear = (F.abs(scaled) < 1e11) & (F.abs(scaled - nearest) < 0.499)
    return F.when(clear, nearest.cast("bigint").cast("double") / F.lit(float(10**digits))).otherwise(exact)


def exact_count_and_sum(value: Column, digits: int) -> tuple[Column, Column]:
    """Count and sum of numbers as ``decimal(18, digits)``, the sum exact, as decimal.

    Numbers of whole units of the last place, which are nearly all, are added as two halves of a whole number; only the
    others are made decimals one by one.
    """
    unit = 10**digits
    units = F.rint(value * F.lit(float(unit)))
    plain = (F.abs(units) < 1e15) & (units / F.lit(float(unit)) == value)
    whole = F.when(plain, units.cast("bigint")).otherwise((value.cast(f"decimal(18,{digits})") * unit).cast("bigint"))
    high, low = F.sum(F.shiftright(whole, 32)), F.sum(whole.bitwiseAND(F.lit(0xFFFFFFFF)))
    total = high.cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(19,0)")
    return F.count(whole), total * F.lit(f"{1 / unit:.{digits}f}").cast(f"decimal({digits},{digits})")


def ratio(part: Column, total: Column) -> Column:
    """part / total as double; NULL when the total is zero."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def share_pct(part: Column, total: Column, digits: int = 4) -> Column:
    """Percentage of ``part`` in ``total``; NULL when the total is zero."""
    return rounded(ratio(part, total) * 100, digits)


def plain_numbers(df):
    """Decimals as doubles, for consumers that have no decimal type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if f.dataType.typeName().startswith("decimal")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
