"""Price and mileage expressions."""

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import fixed_values as fx


def in_local_currency(price: Column, currency: Column, rate: float = fx.RATE_PIPELINE) -> Column:
    return F.when(currency == fx.DOLLAR, price * F.lit(rate)).otherwise(price)


def dollar_flag(currency: Column) -> Column:
    return F.when(currency == fx.DOLLAR, 1).otherwise(0)


def mapped(value: Column, mapping: dict, default) -> Column:
    """Value map with a default, for a handful of literal keys."""
    out = F.lit(default)
    for key, result in mapping.items():
        out = F.when(value == key, F.lit(result)).otherwise(out)
    return out


def in_dollars(price: Column, currency: Column) -> Column:
    return price * mapped(currency, fx.TO_DOLLAR, 1.0)


def new_or_used(km: Column, limit: float = fx.NEW_KM) -> Column:
    return F.when(km <= limit, "new").when(km > limit, "used")


def convert_with_rates(df: DataFrame, rates: DataFrame, price: str = fx.PRICE,
                       currency: str = fx.CURRENCY) -> DataFrame:
    """Currency conversion from a rates table (currency, rate); unknown currencies keep 1."""
    from lotwise.session import join_lookup
    table = rates.select(F.col("currency").alias(currency), F.col("rate").alias("_rate"))
    return (join_lookup(df, table, [currency])
            .withColumn(price, F.col(price) * F.coalesce("_rate", F.lit(1.0))).drop("_rate"))


def log_price(price: Column) -> Column:
    return F.log1p(price)


def price_from_log(value: Column) -> Column:
    return F.expm1(value)
