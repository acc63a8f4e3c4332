"""Text functions: cases taken from the rules, one row each."""

from pyspark.sql import functions as F

from lotwise.functions import price as pr, text as tx
from lotwise.plans.clean import clean_by_version, clean_listings
from lotwise import fixed_values as fx


def apply(spark, fn, *rows):
    width = len(rows[0])
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, " + ", ".join(f"c{j} string" for j in range(width)))
    out = df.select("i", fn(*[F.col(f"c{j}") for j in range(width)]).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def test_turbo(spark):
    assert apply(spark, tx.turbo_flag, ("1.6", "2.0 Titanium"), ("1.6", "Highline"), (None, None), ("TURBOALIMENTADO", None),
                 ("1.4 tsi", "x"), ("1.6", "Trend")) == [1, 0, 0, 1, 1, 1]


def test_power_falls_back_to_title_and_text(spark):
    assert apply(spark, tx.horse_power, ("1.6 110cv", "x 90 hp", "5 cv"), ("110cvx", "x 90 HP", None), (None, None, "con 150 hp"),
                 (None, None, None)) == [110, 90, 150, None]


def test_traction(spark):
    assert apply(spark, tx.traction, ("x 4X4",), ("AWD",), ("4x2 fwd",), ("none",), (None,)) == ["4x4", "4x4", "4x2", None, None]


def test_engine_repair_keeps_null(spark):
    rows = [("1.6", "2.0"), (None, "2.0"), ("TURBO", "1,4 x"), ("2,0 TSI", "1.4"), ("x", "y"), ("1.6f", "9")]
    assert apply(spark, tx.engine_repair, *rows) == [1.6, None, 1.4, 2.0, None, None]


def test_version_cleaning(spark):
    def clean(v, fuel, brand, model, body):
        return tx.clean_version(v, fuel, brand, model, body)
    rows = [("2.4 Sport At", None, None, None, None), ("1.6 VTI 115CV 6AT Nafta 4x4", "Nafta", None, None, None),
            ("Ford Ecosport SE (x)", None, "Ford", "Ecosport", None), ("Automática Edición Álvarez", None, "Álvarez", None, None),
            ("a.b a+b", None, "a+b", None, None), (None, "Nafta", None, None, None)]
    assert apply(spark, clean, *rows) == ["sport", "vti", "se (x)", "edición", "a.b", None]


def test_own_words_are_literal(spark):
    assert apply(spark, lambda c, v: tx.drop_values(c, v), ("x e.t y", "e.t"), ("x ext y", "e.t"), ("a\\Eb", "\\E")) == \
        ["x  y", "x ext y", "a\\Eb"]


def test_kilometres(spark):
    rows = [("58.000 km",), ("58.000",), ("12,500 km",), ("0",), ("unos 70.000",), (None,), ("km",)]
    assert apply(spark, tx.kilometres, *rows) == [58000.0, 58.0, None, 0.0, 70000.0, None, None]
    assert apply(spark, tx.kilometres_plain, ("12,500 KM",), ("",), ("x",)) == [12500.0, None, None]


def test_down_payment(spark):
    df = spark.createDataFrame([(0.0, "El precio publicado es anticipo"), (0.0, "Anticipo y cuotas"), (0.0, "anticipo"),
                                (10.0, "precio de anticipo"), (None, "precio de anticipo"), (0.0, None)], "km double, d string")
    assert [r[0] for r in df.select(tx.down_payment_flag(F.col("km"), F.col("d"))).collect()] == [1, 1, 0, 0, 0, 0]


def test_letters(spark):
    assert apply(spark, tx.ascii_words, ("Azúl ÑANDÚ-½",), ("Straße №5",), (" S ",)) == ["azul nandu 12", "strae 5", "s"]
    assert apply(spark, tx.fold_letters, (" Marrón ",), ("ß",), (None,)) == ["marron", "ß", None]
    assert apply(spark, tx.ascii_words_unicode, ("Azúl ÑANDÚ-½",), ("㎞ x",)) == ["azul nandu 12", "km x"]


def test_repair_letters(spark):
    rows = [("Málaga",), ("a\\u00e1b",), ("plain",), ("Ã¡",), (None,)]
    out = apply(spark, tx.repair_letters, *rows)
    assert out[:3] == ["Málaga", "aáb", "plain"] and out[4] is None


def test_first_integer_and_numeric_text(spark):
    assert apply(spark, tx.first_integer, ("(924)",), ("N/A",), (None,)) == [924, 0, 0]
    assert apply(spark, tx.is_numeric_text, ("1.6",), (".",), ("1.6.2",), (None,)) == [True, False, False, False]


def test_currency(spark):
    df = spark.createDataFrame([(10.0, "US$"), (10.0, "$"), (10.0, None)], "p double, m string")
    assert [r[0] for r in df.select(pr.in_local_currency(F.col("p"), F.col("m"))).collect()] == [14000.0, 10.0, 10.0]


def test_title_fills_empty_version_only(spark):
    df = spark.createDataFrame([("Ford", "Ka", "1.6 AT", "Ford Ka Viral 1.6"), ("Ford", "Ka", None, "Ford Ka Viral"),
                                ("Ford", "Ka", "4x4", "Ford Ka")],
                               f"`{fx.BRAND}` string, `{fx.MODEL}` string, `{fx.VERSION}` string, `{fx.TITLE}` string")
    df = df.withColumn(fx.ENGINE, F.lit("1.6")).withColumn(fx.KM, F.lit("0")).withColumn(fx.TEXT, F.lit(None).cast("string"))
    assert [r[fx.VERSION] for r in clean_listings(df).collect()] == ["viral", None, None]


def test_streaming_frames_take_the_same_expressions(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("58.000 km",), ("0",)], "k string").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("k string").parquet(src).select(tx.kilometres(F.col("k")).alias("km"))
    q = stream.writeStream.format("memory").queryName("km_out").outputMode("append").start()
    try:
        q.processAllAvailable()
        assert sorted(r["km"] for r in spark.table("km_out").collect()) == [0.0, 58000.0]
    finally:
        q.stop()


def test_cleaning_by_distinct_version_equals_cleaning_by_row(spark):
    values = [None, "", "1.6 Large Ring 4x4 6AT 120cv", "super TSI plus", "2,0 T nafta toyota nafta corolla", "TOYOTA", "a  b", "nan", "1.6"]
    owns = [("Nafta", "Toyota", "Corolla", None), (None, "super plus", "large", "suv"), ("toyota", "", None, "nan"), (None, None, None, None)]
    rows = [(v, e, *own, "Toyota large 90 hp", t) for v in values for e in (None, "1.6", "2,0 TSI", "x") for own in owns for t in (None, "motor 150 cv")] * 2
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in (fx.VERSION, fx.ENGINE, fx.FUEL, fx.BRAND, fx.MODEL, fx.BODY, fx.TITLE, fx.TEXT)))
    df = df.withColumn(fx.KM, F.lit("0")).withColumn(fx.CAMERA, F.lit(None).cast("double"))
    plain = clean_listings(df)
    for most in (1, 1000):          # above the limit every row is cleaned on its own
        found = clean_by_version(df, most)
        assert found.schema == plain.schema
        assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    assert clean_by_version(df.drop(fx.VERSION)).columns == clean_listings(df.drop(fx.VERSION)).columns


def test_every_part_goes_through_a_step_once(spark):
    from pyspark.ml import Pipeline
    from lotwise.operators.encoders import Standardize
    from lotwise.operators.fitted import PlainStep
    from lotwise.plans.transform import fit_features

    seen = []

    class Noted(PlainStep):
        def _transform(self, df):
            seen.append(sorted(r["x"] for r in df.collect()))
            return df

    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (5.0, "validation"), (7.0, "test")], "x double, split string")
    model, frames = fit_features(df, Pipeline(stages=[Noted(), Standardize(["x"])]))
    assert seen == [[1.0, 3.0, 5.0, 7.0]]
    assert {n: [r["x"] for r in f.orderBy("x").collect()] for n, f in frames.items()} == {"train": [-1.0, 1.0], "validation": [3.0], "test": [5.0]}
    assert model.transform(df).columns == ["x", "split"]
