"""Stage one: one projection that turns raw listings into typed attributes."""

from pyspark.sql import DataFrame, functions as F

from lotwise import fixed_values as fx
from lotwise.functions import text as tx
from lotwise.session import BROADCAST_ROWS, join_lookup, materialize, materialize_counted


def clean_listings(df: DataFrame) -> DataFrame:
    """Attributes, repaired numbers, cleaned version text and flags.

    Rows stay where they are: no shuffle, no Python.
    """
    version = _col(df, fx.VERSION)
    bare = tx.bare_version(version)
    return _cleaned(df, tx.power_text(version), tx.traction(version), tx.engine_size(version),
                    lambda *own: tx.drop_row_words(bare, *own))


def clean_by_version(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The same result, with all that depends on the raw version alone worked out once per distinct text.

    The texts are looked up from a broadcast table.  Where there are more than
    ``most`` of them every row is cleaned on its own.
    """
    if fx.VERSION not in df.columns:
        return clean_listings(df)
    version = F.col(f"`{fx.VERSION}`")
    texts, n = materialize_counted(df.select(version.alias(fx.VERSION)).where(version.isNotNull()).distinct(), "version-texts")
    if n > most:
        return clean_listings(df)
    bare = tx.bare_version(version)
    table = materialize(texts.select(
        version, tx.power_text(version).alias("_power"), tx.traction(version).alias("_traction"), tx.engine_size(version).alias("_size"),
        bare.alias("_bare"), tx.drop_row_words(bare, *[F.lit(None).cast("string")] * 4).alias("_plain")), "version-parts", wide=True)
    known = join_lookup(df, table, [fx.VERSION], n).select(*[F.col(f"`{c}`") for c in df.columns], "_power", "_traction", "_size", "_bare", "_plain")

    def clean(*own):
        # a text that holds none of the row's own values is left as it is by all of them
        held = F.lit(False)
        for value in own:
            held = held | F.coalesce(F.contains(F.lower("_bare"), F.lower(value)), F.lit(False))
        return F.when(held, tx.drop_row_words(F.col("_bare"), *own)).otherwise(F.col("_plain"))

    out = _cleaned(known, F.col("_power"), F.col("_traction"), F.col("_size"), clean)
    return out.drop("_power", "_traction", "_size", "_bare", "_plain")


def _col(df: DataFrame, name: str):
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _cleaned(df: DataFrame, power, traction, size, clean) -> DataFrame:
    """The projection, given what comes from the raw version and ``clean``(fuel, brand, model, body)."""
    def col(name):
        return _col(df, name)

    raw_version = col(fx.VERSION)
    own = (col(fx.FUEL), col(fx.BRAND), col(fx.MODEL), col(fx.BODY))
    out = (df
           .withColumn(fx.TURBO, tx.turbo_flag(col(fx.ENGINE).cast("string"), raw_version))
           .withColumn(fx.POWER, tx.horse_power(col(fx.TITLE), col(fx.TEXT), found=power))
           .withColumn(fx.TRACTION, traction)
           .withColumn(fx.ENGINE, tx.engine_repair(col(fx.ENGINE).cast("string"), raw_version, size))
           .withColumn("_clean", clean(*own))
           .withColumn(fx.VERSION, F.when(
               F.col("_clean") == "", tx.version_from_title(col(fx.TITLE), own[0], own[1], own[2], own[3]))
               .otherwise(F.col("_clean")))
           .drop("_clean")
           .withColumn(fx.KM, tx.kilometres(col(fx.KM).cast("string"))))
    out = fill_zero(out, [fx.CAMERA])
    return out.withColumn(fx.DOWN_PAYMENT, tx.down_payment_flag(F.col(fx.KM), col(fx.TEXT)))


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null becomes 0; columns that are not there are left alone."""
    for name in columns:
        if name in df.columns:
            df = df.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.lit(0)))
    return df
