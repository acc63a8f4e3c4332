"""The feature pipeline and the price models on the listing view."""

from pyspark.sql import functions as F

from checks import query
from checks.fixture import CLEAN, SPLIT, catalogue, near, plain, raw, sql_near, table
from checks.fitted import parts
from lotwise import fixed_values as fixed
from lotwise.operators import boosting, embed, encoders as enc, impute, stats
from lotwise.operators.relational import feature_columns
from lotwise.plans import train as tr
from lotwise.plans.clean import clean_by_version, clean_listings
from lotwise.plans.transform import feature_pipeline, fit_features
from lotwise.session import materialize, scratch_path

c = F.col
HALVED_SETS, HALVED_TREES = 27, 81
BASE = ["marca", "modelo", "version", "motor", "cv", "kilometros", "anio", "turbo", "camara"]


def features(spark, sf):
    """Encoded, filled and scaled listings with their split, without name matching."""
    df = parts(spark, sf, *BASE, "combustible", "transmision", "vendedor", "precio", "descripcion")
    train = df.where("split = 'train'")
    for step in (impute.FillVersion("version", "marca", "modelo"),
                 enc.TargetMean(["marca", "modelo", "version"], "precio"),
                 enc.Standardize(["motor", "cv", "kilometros", "anio"]),
                 enc.OneHot(["combustible", "transmision", "vendedor"])):
        model = step.fit(train)
        train, df = model.transform(train), model.transform(df)
    kept = [x for x in df.columns if x in BASE or x.startswith(("combustible_", "transmision_", "vendedor_"))]
    return materialize(df.select("idx", "split", "precio", "descripcion", *kept), "features")


def pieces(df, names=("train", "validation", "test")):
    drop = [x for x in ("idx", "split", "descripcion") if x in df.columns]
    return {n: df.where(c("split") == n).drop(*drop) for n in names}


def rounded(df):
    return df.select(*[F.round(x, 4).alias(x) if t == "double" else c(x) for x, t in df.dtypes])


@query("feature_pipeline_i23")
def pipeline(spark, sf):
    listed = materialize(enc.hash_split(clean_by_version(raw(spark, sf)), "idx"), "clean")
    _, frames = fit_features(listed, feature_pipeline(catalogue(spark, sf)))
    out = None
    for name, frame in frames.items():
        part = frame.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out.toDF(*[x.replace(" ", "_").replace("$", "S") for x in out.columns]))


BOOSTED = ("script", "baseline")
_fitted: dict[tuple[str, str], tuple] = {}


def boosted_sets(spark, sf):
    """(rows with their split, model by set): grown together once, for all queries that look at them."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _fitted:
        df = features(spark, sf)
        used = feature_columns(df.drop("idx", "split", "descripcion"), "precio")
        models = boosting.fit_boosted(df.where("split = 'train'"), "precio", used, [tr.boosting_set(n) for n in BOOSTED], key="idx")
        _fitted[known] = (df, dict(zip(BOOSTED, models, strict=True)))
    return _fitted[known]


@query("boosted_trees_j1_j12")
def boosted(spark, sf):
    df, models = boosted_sets(spark, sf)
    return rounded(tr.evaluate_boosted(models, df, "precio"))


@query("staged_errors_j7")
def staged(spark, sf):
    """Error on every part after each tree of the script's set."""
    df, models = boosted_sets(spark, sf)
    return rounded(models["script"].staged_errors(df, "split"))


@query("linear_model_j2")
def linear(spark, sf):
    split = pieces(features(spark, sf))
    model = tr.PriceModel.fit(split["train"], tr.linear_model(), "precio")
    return rounded(model.importance(spark, 50))


@query("log_target_h20")
def log_target(spark, sf):
    split = pieces(features(spark, sf))
    return rounded(tr.evaluate(tr.PriceModel.fit(split["train"], tr.linear_model(), "precio", log=True), split))


@query("model_comparison_j3_j4")
def comparison(spark, sf):
    split = pieces(features(spark, sf), ("train", "validation"))
    return rounded(tr.compare_models(split, {"linear": tr.linear_model(), "forest": tr.random_forest(depth=12), "boosted": tr.boosted_trees("baseline")}, "precio"))


def drawn(space, n):
    return [boosting.Boosting(**x) for x in tr.draw(space, n)]


PENALTIES = {"regParam": [0.0, *[10.0 ** k for k in range(-4, 5)]], "elasticNetParam": [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]}


@query("random_search_j5_j7")
def search(spark, sf):
    train = features(spark, sf).where("split = 'train'").drop("split", "descripcion")
    found = tr.random_search(train, tr.linear_model(), PENALTIES, 50, "idx", "precio", parallelism=8)
    return rounded(spark.createDataFrame([(s["regParam"], s["elasticNetParam"], float(r)) for s, r in found], "penalty double, mix double, rmse double"))


@query("halving_search_j6")
def halving(spark, sf):
    """Draws from the space of tree parameters; the trees are what the rounds have more of."""
    train = features(spark, sf).where("split = 'train'").drop("split", "descripcion")
    used = feature_columns(train.drop("idx"), "precio")
    found = boosting.halving_staged(train, "precio", used, drawn(fixed.TREE_SPACE, HALVED_SETS), "idx", most=HALVED_TREES)
    return rounded(spark.createDataFrame([(r["trees"], r["sets"], r["best"].depth, r["best"].rate, float(r["rmse"])) for r in found],
                                         "trees int, sets int, depth int, rate double, rmse double"))


@query("importance_j8")
def importance(spark, sf):
    """Mean gain per split of the script's set."""
    _, models = boosted_sets(spark, sf)
    return rounded(spark.createDataFrame(models["script"].importance(10), "feature string, gain double"))


@query("ablation_j10")
def ablation(spark, sf):
    split = pieces(features(spark, sf), ("train", "validation"))
    return rounded(tr.without_columns(split, tr.linear_model(), ["marca", "modelo", "version"], "precio"))


@query("embedding_sweep_j11")
def sweep(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    df = materialize(enc.hash_split(docs.select("doc_id", "text", c("n_chars").cast("double").alias("n_chars"), c("quality").cast("double").alias("quality")), "doc_id"), "texts")
    scores = embed.DescriptionScores(max(fixed.EMBED_SWEEP), "text").fit(df.where("split = 'train'"))
    return rounded(tr.embedding_sweep(df, fixed.EMBED_SWEEP, scores, ["n_chars"], tr.linear_model(), "quality"))


@query("line_of_one_feature_j2", f"""{SPLIT}, t AS (SELECT CAST(precio AS DOUBLE) AS y, CAST(anio AS DOUBLE) AS x FROM parts WHERE split = 'train')
  SELECT round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept FROM t""")
def one_line(spark, sf):
    train = parts(spark, sf, "anio", "precio").where("split = 'train'").select(c("anio").cast("double").alias("anio"), c("precio").cast("double").alias("precio"))
    model = tr.PriceModel.fit(train, tr.linear_model(), "precio").model
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("saved_model_a7", f"{SPLIT} SELECT split, count(*) AS n, true AS same FROM parts GROUP BY split")
def saved(spark, sf):
    split = pieces(features(spark, sf))
    path = scratch_path(spark, "model")
    model = tr.PriceModel.fit(split["train"], tr.linear_model(), "precio")
    model.save(path)
    again = tr.predictions(tr.PriceModel.load(path), split).groupBy("split").agg(F.count("*").alias("n"), F.sum("prediction").alias("b"))
    once = tr.predictions(model, split).groupBy("split").agg(F.sum("prediction").alias("a"))
    return once.join(again, "split").select("split", "n", (F.abs(c("a") - c("b")) <= 1e-9 * F.abs("a")).alias("same"))


@query("worst_predictions_e7_c5")
def worst(spark, sf):
    df = features(spark, sf)
    split = {"validation": df.where("split = 'validation'").drop("split", "descripcion")}
    model = tr.PriceModel.fit(df.where("split = 'train'").drop("idx", "split", "descripcion"), tr.linear_model(), "precio")
    scored = stats.residuals(tr.predictions(model, split), "precio")
    top = scored.orderBy(F.desc("abs_error"), "idx").limit(10).select("idx", F.round("abs_error", 2).alias("abs_error"))
    # only the listings found are cleaned
    found = plain(clean_listings(raw(spark, sf).join(F.broadcast(top), "idx")))
    return found.select("idx", "marca", "modelo", "version", "precio", "abs_error")


@query("minimum_slice", f"""{CLEAN}, g AS (SELECT avg(precio) AS g FROM clean), m AS (SELECT marca, (count(precio) * avg(precio) + 10.0::DOUBLE * max(g)) / (count(precio) + 10) AS code FROM clean, g GROUP BY marca)
  SELECT idx, {sql_near('m.code')} AS marca_code, motor, kilometros, traccion, cv, turbo, round(CASE WHEN moneda = 'US$' THEN precio * 1400.0 ELSE precio END, 2) AS precio FROM clean JOIN m USING (marca)""")
def minimum_slice(spark, sf):
    df = materialize(clean_listings(raw(spark, sf)), "clean")
    coded = enc.TargetMean([fixed.BRAND]).fit(df).transform(df)
    out = plain(enc.ConvertCurrency().transform(coded))
    return out.select("idx", near("marca").alias("marca_code"), "motor", "kilometros", "traccion", "cv", "turbo", F.round("precio", 2).alias("precio"))
