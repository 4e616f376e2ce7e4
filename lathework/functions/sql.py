"""The library's functions for SQL text: temporary SQL functions, which the optimizer unfolds into the plan of the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lathework.functions.values import DISCOUNT_TIERS


def register_functions(spark: SparkSession) -> None:
    """``ratio(first, second)`` and ``tiered(amount)`` as in ``functions.values``."""
    tiers = " ".join(f"WHEN amount >= {least!r}D THEN amount * {rate!r}D" for least, rate in sorted(DISCOUNT_TIERS, reverse=True))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ratio(first DOUBLE, second DOUBLE) RETURNS DOUBLE RETURN try_divide(second, first)")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION tiered(amount DOUBLE) RETURNS DOUBLE RETURN CASE {tiers} ELSE 0D END")


def register_trailing_average(spark: SparkSession, name: str, view: str, ticker: str, date: str, price: str, days: int = 20) -> None:
    """``name(first, last)``: a table function with the rows of ``stocks.trailing_average`` over ``view`` between two dates, both included.

    Columns are ``ticker``, ``date``, ``price`` and ``average``. The average looks back past the first date.
    """
    kinds = dict(spark.table(view).dtypes)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(first DATE, last DATE)
        RETURNS TABLE (ticker {kinds[ticker]}, date {kinds[date]}, price {kinds[price]}, average DOUBLE)
        RETURN SELECT ticker, date, price, average FROM (
            SELECT ticker, date, price, coalesce(avg(price) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {int(days)} PRECEDING AND 1 PRECEDING), 0D) AS average
            FROM (SELECT `{ticker}` AS ticker, `{date}` AS date, max(`{price}`) AS price FROM {view} GROUP BY 1, 2))
        WHERE date >= {name}.first AND date <= {name}.last""")
