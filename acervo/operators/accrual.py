"""Debts through ordered periods of different rules: simple sums within a period, consolidation between.

A debt's span is cut at the borders of the periods.  Within a period the
monthly rates of correction and of interest add up (no compounding): the
principal is corrected by the sum of the one, interest is the corrected
principal times the sum of the other.  At a period's end both are consolidated
into the principal of the next, rounded to cents.  A period with one index for
both, such as the base rate from January 2022 on, has no correction, only
interest; the two are never added to another index.

Sums of rates come from running totals by period, so a debt looks up two
months for each period however long it runs; no debt is spread over its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY, RATE = "decimal(18,2)", "decimal(12,6)"


def running(rates: DataFrame) -> DataFrame:
    """(period, month, correction, interest): sums from the period's first month on. rates: period, month (its first day), correction, interest, a row for each month."""
    along = Window.partitionBy("period").orderBy("month")
    return rates.select("period", "month", *[F.sum(F.coalesce(F.col(c), F.lit(0)).cast(RATE)).over(along).cast(RATE).alias(c) for c in ("correction", "interest")])


def method_changes(rates: DataFrame) -> DataFrame:
    """(period, first_month, last_month) in order, the borders at which the method changes."""
    return rates.groupBy("period").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def accrued(debts: DataFrame, rates: DataFrame, periods: list[str], principal: str, first: str, last: str) -> DataFrame:
    """debts with corrected_i and interest_i for each period in order, and the total at the end.

    first, last: the first and the last month (first days) that accrue.  Rates
    have a row for each month from a period's first to its last; a period
    outside a debt's span leaves it as it is, months that no period has accrue
    nothing."""
    sums = running(rates)
    out = debts.withColumn("total", F.col(principal).cast(MONEY))
    for i, period in enumerate(periods):
        mine = sums.where(F.col("period") == period)
        ends = mine.agg(F.min("month").alias("_begin"), F.max("month").alias("_end"))  # one row
        at = lambda x, df=mine: df.select(F.col("month").alias(f"_m{x}"), F.col("correction").alias(f"_correction{x}"), F.col("interest").alias(f"_interest{x}"))
        cut = out.join(ends).withColumns({"_to": F.least(F.col(last), F.col("_end")), "_before": F.add_months(F.greatest(F.col(first), F.col("_begin")), -1)})
        met = cut.join(at(1), F.col("_to") == F.col("_m1"), "left").join(at(0), F.col("_before") == F.col("_m0"), "left")
        rate = lambda c: F.when(F.col("_to") > F.col("_before"), F.coalesce(F.col(f"_{c}1"), F.lit(0)) - F.coalesce(F.col(f"_{c}0"), F.lit(0))).otherwise(0).cast(RATE)
        corrected = met.withColumn(f"corrected_{i}", F.round(F.col("total") * (1 + rate("correction")), 2).cast(MONEY))
        charged = corrected.withColumn(f"interest_{i}", F.round(F.col(f"corrected_{i}") * rate("interest"), 2).cast(MONEY))
        out = charged.withColumn("total", (F.col(f"corrected_{i}") + F.col(f"interest_{i}")).cast(MONEY)).drop("_begin", "_end", "_to", "_before", *[f"_{c}{x}" for c in ("m", "correction", "interest") for x in (0, 1)])
    return out


def statement(debts: DataFrame, rates: DataFrame, before: str, after: str, **columns: str) -> DataFrame:
    """The statement of a debt over the transition: principal corrected and interest until the consolidation, interest from then on, and the total of all three."""
    out = accrued(debts, rates, [before, after], **columns)
    at_border = F.col("corrected_0") + F.col("interest_0")
    return out.select(*debts.columns, F.col("corrected_0").alias("corrected"), F.col("interest_0").alias("interest"), (F.col("total") - at_border).cast(MONEY).alias("later_interest"), "total")


def doubled(kinds: Column, whole: str) -> Column:
    """Whether a calculation adds an index that is correction and interest at once to any other."""
    return F.array_contains(kinds, whole) & (F.size(F.array_distinct(kinds)) > 1)
