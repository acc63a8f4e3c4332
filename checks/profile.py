"""Filters, joins, counts, rankings and metrics over the given tables."""

from pyspark.sql import functions as F

from checks import query
from checks import fixture as fx
from checks.fixture import CLEAN, L, LC, SPLIT, catalogue, listings, near, plain, raw, sql_near, table
from lotwise import fixed_values as fv
from lotwise.functions import price as pr, text as tx
from lotwise.operators import relational as rel, stats
from lotwise.operators.quantiles import exact_percentiles, percentile_clip
from lotwise.plans.clean import clean_listings
from lotwise.session import materialize

c = F.col


def cleaned(spark, sf):
    return plain(clean_listings(raw(spark, sf)))


def version_counts(spark, sf):
    """(marca, modelo, version, n) of cleaned versions: listings alike in all that the version is made of are counted, then cleaned once."""
    read = [fv.VERSION, fv.TITLE, fv.FUEL, fv.BRAND, fv.MODEL]
    alike = raw(spark, sf).groupBy(*[c(f"`{x}`") for x in read]).agg(F.count("*").alias("n"))
    rows = materialize(plain(clean_listings(alike)).select("marca", "modelo", "version", "n"), "versions", wide=True)
    return rows.where("version is not null")


# ------------------------------------------------------------------ B
@query("drop_columns_b1", f"{L} SELECT idx, marca, precio FROM listings")
def drop_columns(spark, sf):
    df = listings(spark, sf)
    return df.drop(*[x for x in df.columns if x not in ("idx", "marca", "precio")], "absent")


@query("order_columns_b2", f"{L} SELECT marca, modelo, precio, * EXCLUDE (marca, modelo, precio) FROM listings ORDER BY marca, modelo")
def order_columns(spark, sf):
    return rel.sorted_by(rel.first_columns(listings(spark, sf), ["marca", "modelo", "absent", "precio"]), ["marca", "modelo"])


@query("feature_guard_b3", "SELECT l_extendedprice, l_quantity, l_discount, l_tax FROM lineitem")
def feature_guard(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return df.select("l_extendedprice", *rel.feature_columns(df, "l_extendedprice"))


@query("range_masks_b4", f"""{CLEAN} SELECT idx, precio FROM clean WHERE kilometros < 500 AND precio < 30000 AND (anticipo = 1 OR moneda = '$')
  AND precio BETWEEN 1000 AND 25000""")
def range_masks(spark, sf):
    return cleaned(spark, sf).where((c("kilometros") < 500) & (c("precio") < 30000)
                                    & ((c("anticipo") == 1) | (c("moneda") == "$"))
                                    & c("precio").between(1000, 25000)).select("idx", "precio")


@query("rename_assign_b7", """SELECT doc_id AS idx, quality AS cosmetic, toxic AS functional,
  'C:' || quality || ' F:' || toxic || ' S:' || (quality * toxic) AS damage_combination FROM labels""")
def rename_assign(spark, sf):
    df = table(spark, sf, "labels").withColumn("severe", c("quality") * c("toxic"))
    return df.select(c("doc_id").alias("idx"), c("quality").alias("cosmetic"), c("toxic").alias("functional"),
                     F.format_string("C:%d F:%d S:%d", "quality", "toxic", "severe").alias("damage_combination"))


@query("distinct_rows_b9", f"{L} SELECT DISTINCT marca, modelo, version, motor, color FROM listings")
def distinct_rows(spark, sf):
    return listings(spark, sf).select("marca", "modelo", "version", "motor", "color").dropDuplicates()


@query("sample_rows_b10", f"{L} SELECT idx, marca FROM listings ORDER BY {fx.HASH}, idx LIMIT 10")
def sample_rows(spark, sf):
    return rel.sample_rows(listings(spark, sf).select("idx", "marca"), "idx", 10)


@query("is_standardized_b11", """WITH z AS (SELECT (o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders) AS a,
    o_custkey AS b FROM orders)
  SELECT abs(avg(a)) < 0.2 AND abs(stddev_samp(a) - 1) < 0.2 AS scaled, abs(avg(b)) < 0.2 AND abs(stddev_samp(b) - 1) < 0.2 AS unscaled FROM z""")
def is_standardized(spark, sf):
    orders = table(spark, sf, "orders").select(c("o_totalprice").alias("a"), c("o_custkey").alias("b"))
    m = orders.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s"))
    scaled = orders.select(((c("a") - m.select("m").scalar()) / m.select("s").scalar()).alias("a"))
    flag = rel.is_standardized(orders.select("b"))
    return rel.is_standardized(scaled).select(c("standardized").alias("scaled"), flag.scalar().alias("unscaled"))


@query("percentile_clip_b12", f"""{CLEAN}, used AS (SELECT * FROM clean WHERE kilometros > 1000),
  q AS (SELECT quantile_cont(kilometros, 0.001) k1, quantile_cont(kilometros, 0.995) k2, quantile_cont(precio, 0.001) p1, quantile_cont(precio, 0.995) p2 FROM used)
  SELECT idx, kilometros, precio FROM used, q WHERE kilometros BETWEEN k1 AND k2 AND precio BETWEEN p1 AND p2""")
def clip(spark, sf):
    return percentile_clip(cleaned(spark, sf).select("idx", "kilometros", "precio"), ["kilometros", "precio"],
                           0.001, 0.995, where=c("kilometros") > 1000)


@query("numeric_columns_b13", f"{CLEAN} SELECT motor, kilometros, precio, camara, anio, turbo, cv, anticipo FROM clean")
def numeric(spark, sf):
    df = cleaned(spark, sf)
    return df.select(*rel.numeric_columns(df))


# ------------------------------------------------------------------ C
@query("left_join_labels_c4", """SELECT d.doc_id, d.source, l.quality, l.toxic, l.doc_id % 7 AS source_raw
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def left_join(spark, sf):
    labels = table(spark, sf, "labels").withColumn("source", c("doc_id") % 7)
    return rel.attach(table(spark, sf, "documents").select("doc_id", "source"), labels, "doc_id")


@query("semi_join_worst_c5", f"""{L}, worst AS (SELECT idx FROM listings ORDER BY precio DESC, idx LIMIT 10)
  SELECT idx, marca, version FROM listings WHERE idx IN (SELECT idx FROM worst)""")
def semi_join(spark, sf):
    df = listings(spark, sf)
    worst = rel.top_rows(df.select("idx", "precio"), 10, F.desc("precio"), c("idx"))
    return rel.only_in(df, worst, ["idx"]).select("idx", "marca", "version")


@query("unused_catalogue_c6", f"""{LC} SELECT DISTINCT brand, model, version FROM catalogue c
  WHERE version IS NOT NULL AND NOT EXISTS (SELECT 1 FROM listings l WHERE l.marca = c.brand AND l.modelo = c.model AND l.titulo = c.brand || ' ' || c.model || ' ' || lower(c.version) AND l.precio > 85000)""")
def unused(spark, sf):
    cat = catalogue(spark, sf).where("version is not null").withColumn(
        "titulo", F.concat_ws(" ", "brand", "model", F.lower("version")))
    used = listings(spark, sf).where("precio > 85000").select(c("marca").alias("brand"), c("modelo").alias("model"), "titulo")
    return rel.not_in(cat, used, ["brand", "model", "titulo"]).select("brand", "model", "version")


@query("value_map_c7", f"""{L} SELECT idx, CASE lower(trim(color)) WHEN 'blanca' THEN 'blanco' WHEN 'negro' THEN 'negro' WHEN 'roja' THEN 'rojo' ELSE 'Otro' END AS color,
  CASE moneda WHEN 'US$' THEN 1.0::DOUBLE WHEN '$' THEN 0.0011::DOUBLE ELSE 1.0::DOUBLE END AS factor FROM listings""")
def value_map(spark, sf):
    table_ = spark.createDataFrame([("blanca", "blanco"), ("negro", "negro"), ("roja", "rojo")], "value string, mapped string")
    df = listings(spark, sf).select("idx", tx.colour_text(c("color")).alias("color"),
                                    pr.mapped(c("moneda"), {"US$": 1.0, "$": 0.0011}, 1.0).alias("factor"))
    return rel.map_values(df, table_, "color", "Otro")


@query("target_kept_c8", f"{CLEAN} SELECT marca, round(avg(precio), 4) AS mean_price, count(precio) AS n FROM clean WHERE marca IS NOT NULL GROUP BY marca")
def target_kept(spark, sf):
    return (cleaned(spark, sf).where("marca is not null").groupBy("marca")
            .agg(F.round(F.avg("precio"), 4).alias("mean_price"), F.count("precio").alias("n")))


# ------------------------------------------------------------------ D
@query("value_counts_d1", f"{L} SELECT color, count(*) AS n FROM listings WHERE color IS NOT NULL GROUP BY color")
def value_counts(spark, sf):
    return stats.value_counts(listings(spark, sf), "color").orderBy(F.desc("n"), "color")


@query("group_sizes_d2", f"{L} SELECT marca, modelo, version, count(*) AS n FROM listings WHERE version IS NOT NULL GROUP BY ALL")
def group_sizes(spark, sf):
    return stats.value_counts(listings(spark, sf), "marca", "modelo", "version")


@query("versions_per_model_d3", f"{L} SELECT marca, modelo, count(DISTINCT version) AS items FROM listings GROUP BY ALL HAVING count(DISTINCT version) > 1")
def versions_per_model(spark, sf):
    return stats.groups_with_many(listings(spark, sf), ["marca", "modelo"], "version")


@query("distinct_counts_d4", f"""{L} SELECT 'marca' AS "column", count(DISTINCT marca) AS n_distinct FROM listings
  UNION ALL SELECT 'version', count(DISTINCT version) FROM listings UNION ALL SELECT 'color', count(DISTINCT color) FROM listings""")
def distinct_counts(spark, sf):
    return stats.distinct_report(listings(spark, sf), ["marca", "version", "color"])


@query("market_share_d5", f"""{L} SELECT marca, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM listings), 2) AS pct
  FROM listings WHERE marca IS NOT NULL GROUP BY marca""")
def market_share(spark, sf):
    return stats.share_of_rows(listings(spark, sf), "marca")


@query("null_profile_d6", f"{L}, n AS (SELECT count(*) AS n FROM listings) SELECT \"column\", nulls, nulls / n AS ratio FROM ("
       + " UNION ALL ".join(f"SELECT '{x}' AS \"column\", count(*) - count({x}) AS nulls FROM listings"
                            for x in ("idx", "version", "motor", "kilometros", "combustible", "color", "camara", "descripcion"))
       + ") t, n WHERE nulls > 0")
def null_profile(spark, sf):
    return stats.null_profile(listings(spark, sf), ["idx", "version", "motor", "kilometros", "combustible", "color", "camara", "descripcion"])


@query("mode_per_group_d7", f"""{CLEAN}, n AS (SELECT marca, modelo, cv, count(*) AS n FROM clean WHERE cv IS NOT NULL GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo ORDER BY n DESC, cv) AS rn FROM n) SELECT marca, modelo, cv FROM r WHERE rn = 1""")
def mode_per_group(spark, sf):
    return stats.mode_per_group(cleaned(spark, sf), ["marca", "modelo"], "cv")


_CLUSTERS = """n AS (SELECT marca, version, count(*) AS n FROM clean WHERE version IS NOT NULL GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY marca ORDER BY n DESC, version) AS rn, sum(n) OVER (PARTITION BY marca) AS size FROM n)"""


@query("cluster_labels_d8", f"{CLEAN}, {_CLUSTERS} SELECT marca, version AS label, CAST(size AS BIGINT) AS size FROM r WHERE rn = 1")
def cluster_labels(spark, sf):
    return stats.cluster_labels(version_counts(spark, sf), ["marca"], "version", "n")


@query("category_means_d9", f"""{L} SELECT version, {sql_near('avg(precio)')} AS mean, count(precio) AS n,
  round((SELECT avg(precio) FROM listings), 4) AS overall FROM listings WHERE version IS NOT NULL GROUP BY version""")
def category_means(spark, sf):
    df = listings(spark, sf)
    overall = df.agg(F.avg("precio")).scalar()
    return (df.where("version is not null").groupBy("version")
            .agg(near(F.avg("precio")).alias("mean"), F.count("precio").alias("n"))
            .withColumn("overall", F.round(overall, 4)))


@query("percentiles_d10", """SELECT round(quantile_cont(l_extendedprice, 0.01), 4) AS p01, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem""")
def percentiles(spark, sf):
    df = table(spark, sf, "lineitem")
    found = exact_percentiles(df, ["l_extendedprice"], [0.01, 0.5, 0.99])["l_extendedprice"]
    return df.agg(*[F.round(F.lit(v), 4).alias(n) for n, v in zip(("p01", "p50", "p99"), found)])


_HIST = "least(floor((precio - low) / ((high - low) / 40)) + 1, 40)"


@query("histogram_d11", f"""{CLEAN}, rows AS (SELECT *, CASE WHEN kilometros <= 1000 THEN 'new' WHEN kilometros > 1000 THEN 'used' END AS state FROM clean),
  e AS (SELECT state, min(precio) AS low, max(precio) AS high FROM rows WHERE state IS NOT NULL GROUP BY state)
  SELECT state, CAST({_HIST} AS BIGINT) AS bin, count(*) AS n, min(low) AS low, max(high) AS high FROM rows JOIN e USING (state) GROUP BY ALL""")
def histogram(spark, sf):
    df = cleaned(spark, sf).withColumn("state", pr.new_or_used(c("kilometros")))
    return stats.histogram(df, "precio", 40, by=["state"])


@query("flag_summary_d12", """WITH t AS (SELECT count(*) AS rows, sum(quality) AS quality, sum(toxic) AS toxic, sum(greatest(quality, toxic)) AS a FROM labels)
  SELECT 'quality' AS flag, CAST(quality AS BIGINT) AS n, round_even(quality * 100.0::DOUBLE / rows, 1) AS pct FROM t
  UNION ALL SELECT 'toxic', CAST(toxic AS BIGINT), round_even(toxic * 100.0::DOUBLE / rows, 1) FROM t
  UNION ALL SELECT 'any', CAST(a AS BIGINT), round_even(a * 100.0::DOUBLE / rows, 1) FROM t""")
def flag_summary(spark, sf):
    return stats.flag_summary(table(spark, sf, "labels"), ["quality", "toxic"])


@query("flag_combinations_d12", """SELECT 'C:' || quality || ' F:' || toxic || ' S:' || (quality * toxic) AS damage_combination, count(*) AS n,
  round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 1) AS pct FROM labels GROUP BY 1""")
def flag_combinations(spark, sf):
    df = table(spark, sf, "labels").withColumn("severe", c("quality") * c("toxic"))
    return stats.flag_combinations(df, "quality", "toxic", "severe")


def predicted(spark, sf):
    """Predictions made from the tables: quantity times the part's retail price."""
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return items.join(parts, c("l_partkey") == c("p_partkey")).select(
        (c("l_orderkey") * 8 + c("l_linenumber")).alias("row_id"), c("p_brand").alias("marca"),
        c("l_extendedprice").alias("y"), (c("l_quantity") * c("p_retailprice")).alias("prediction"),
        c("l_quantity").alias("x"),
        F.when(c("l_orderkey") % 5 == 0, "validation").otherwise("train").alias("split"))


_PRED = """WITH pred AS (SELECT l_orderkey * 8 + l_linenumber AS row_id, p_brand AS marca, l_extendedprice AS y, l_quantity * p_retailprice AS prediction, l_quantity AS x,
  CASE WHEN l_orderkey % 5 = 0 THEN 'validation' ELSE 'train' END AS split, l_extendedprice - l_quantity * p_retailprice AS e
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query("regression_metrics_d13", f"""{_PRED} SELECT split, count(*) AS n, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 4) AS rmse,
  round(1 - sum(e * e) / (count(*) * var_pop(y)), 6) AS r2, round(avg(abs(e)), 4) AS mae, round(1 - var_pop(e) / var_pop(y), 6) AS evs,
  round(max(abs(e)), 4) AS max_err, round(quantile_cont(abs(e), 0.5), 4) AS medae FROM pred GROUP BY split""")
def metrics(spark, sf):
    out = stats.regression_metrics(predicted(spark, sf), "y")
    digits = {"mse": 2, "rmse": 4, "r2": 6, "mae": 4, "evs": 6, "max_err": 4, "medae": 4}
    return out.select("split", "n", *[F.round(k, d).alias(k) for k, d in digits.items()])


@query("error_by_brand_d14", f"""{_PRED} SELECT marca, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(abs(e))), 4) AS sqrt_mae, count(*) AS n
  FROM pred GROUP BY marca ORDER BY avg(abs(e)) DESC, marca LIMIT 10""")
def error_by_brand(spark, sf):
    out = stats.error_by_group(stats.residuals(predicted(spark, sf), "y"), "marca")
    return out.select("marca", F.round("mae", 4).alias("mae"), F.round("sqrt_mae", 4).alias("sqrt_mae"), "n")


@query("largest_brands_d14", f"""{_PRED} SELECT marca, round(sqrt(avg(abs(e))), 4) AS sqrt_mae, count(*) AS n FROM pred GROUP BY marca ORDER BY count(*) DESC, marca LIMIT 10""")
def largest_brands(spark, sf):
    out = stats.largest_groups_error(stats.residuals(predicted(spark, sf), "y"), "marca")
    return out.select("marca", F.round("sqrt_mae", 4).alias("sqrt_mae"), "n")


def _summary_sql(x):
    return f"""SELECT '{x}' AS "column", count({x}) AS n, count(*) - count({x}) AS nulls, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std,
  CAST(min({x}) AS DOUBLE) AS min, round(quantile_cont({x}, 0.25), 4) AS q1, round(quantile_cont({x}, 0.5), 4) AS median, round(quantile_cont({x}, 0.75), 4) AS q3, CAST(max({x}) AS DOUBLE) AS max FROM clean"""


@query("column_summary_d15", CLEAN + " " + " UNION ALL ".join(map(_summary_sql, ("precio", "kilometros", "cv"))))
def column_summary(spark, sf):
    out = stats.column_summary(cleaned(spark, sf), ["precio", "kilometros", "cv"])
    return out.select("column", "n", "nulls", *[F.round(x, 4).alias(x) for x in ("mean", "std")], "min",
                      *[F.round(x, 4).alias(x) for x in ("q1", "median", "q3")], "max")


@query("straight_line_d16", f"""{_PRED} SELECT round(regr_slope(abs(e), x), 4) AS slope, round(regr_intercept(abs(e), x), 2) AS intercept, round(regr_r2(abs(e), x), 6) AS r2 FROM pred""")
def straight_line(spark, sf):
    out = stats.straight_line(stats.residuals(predicted(spark, sf), "y"), "abs_error", "x")
    return out.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"))


@query("cluster_summary_d17", f"{CLEAN}, {_CLUSTERS} SELECT marca, version AS label, CAST(size AS BIGINT) AS size FROM r WHERE rn = 1 ORDER BY size DESC, marca")
def cluster_summary(spark, sf):
    out = stats.cluster_labels(version_counts(spark, sf), ["marca"], "version", "n")
    return out.orderBy(F.desc("size"), "marca")


@query("catalogue_report_d18", """WITH cat AS (SELECT p_brand AS brand, CASE WHEN p_size % 10 = 0 THEN 'N/A' ELSE p_type END AS model, CASE WHEN p_type = 'PROMO' THEN 'N/A' ELSE p_name END AS version, p_size AS quantity FROM part)
  SELECT count(*) AS n_rows, count(DISTINCT brand) AS n_brands, count(DISTINCT CASE WHEN model <> 'N/A' THEN model END) AS n_models,
    count(DISTINCT CASE WHEN version <> 'N/A' THEN version END) AS n_versions, CAST(sum(quantity) AS BIGINT) AS quantity FROM cat""")
def catalogue_report(spark, sf):
    cat = table(spark, sf, "part").select(
        c("p_brand").alias("brand"), F.when(c("p_size") % 10 == 0, "N/A").otherwise(c("p_type")).alias("model"),
        F.when(c("p_type") == "PROMO", "N/A").otherwise(c("p_name")).alias("version"), c("p_size").alias("quantity"))
    return stats.catalogue_report(cat)


# ------------------------------------------------------------------ E
@query("top_models_of_top_brands_e1", f"""{L}, b AS (SELECT marca FROM listings GROUP BY marca ORDER BY count(*) DESC, marca LIMIT 5),
  n AS (SELECT marca, modelo, count(*) AS n FROM listings WHERE marca IN (SELECT marca FROM b) GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY marca ORDER BY n DESC, modelo) AS place FROM n) SELECT marca, modelo, n, place FROM r WHERE place <= 5""")
def top_models(spark, sf):
    return stats.top_in_top_groups(listings(spark, sf), "marca", "modelo", 5, 5).withColumn("place", c("place").cast("bigint"))


@query("group_mode_to_rows_e2", f"""{CLEAN}, n AS (SELECT marca, modelo, cv, count(*) AS n FROM clean WHERE cv IS NOT NULL GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo ORDER BY n DESC, cv) AS rn FROM n)
  SELECT idx, coalesce(c.cv, r.cv) AS cv FROM clean c LEFT JOIN r ON c.marca = r.marca AND c.modelo = r.modelo AND rn = 1""")
def group_mode(spark, sf):
    from lotwise.operators.impute import fill_by_group_mode
    return fill_by_group_mode(cleaned(spark, sf), ["cv"], ["marca", "modelo"]).select("idx", "cv")


@query("percent_of_total_e3", f"""{CLEAN} SELECT version, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / (SELECT count(version) FROM clean), 2) AS pct FROM clean WHERE version IS NOT NULL GROUP BY version""")
def percent(spark, sf):
    counts = version_counts(spark, sf).groupBy("version").agg(F.sum("n").alias("n"))
    return stats.share_of_total(materialize(counts, "counts", wide=True))       # the total reads them once more


@query("first_best_e4", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_best(spark, sf):
    return rel.best_row(table(spark, sf, "orders"), ["o_custkey"], [-c("o_totalprice"), c("o_orderkey")], ["o_orderkey", "o_totalprice"])


@query("frequency_order_e5", f"""{L}, n AS (SELECT color, count(*) AS n_same FROM listings WHERE color IS NOT NULL GROUP BY color)
  SELECT idx, color, n_same FROM listings JOIN n USING (color)""")
def frequency_order(spark, sf):
    return rel.frequency_order(listings(spark, sf).select("idx", "color"), "color")


@query("mixed_sort_e6", "SELECT p_brand, p_type, p_size, p_partkey FROM part ORDER BY p_brand, p_type, p_size DESC")
def mixed_sort(spark, sf):
    return table(spark, sf, "part").orderBy("p_brand", "p_type", F.desc("p_size")).select("p_brand", "p_type", "p_size", "p_partkey")


@query("top_rows_e7", f"{_PRED} SELECT row_id, round(abs(e), 4) AS abs_error FROM pred ORDER BY abs(e) DESC, row_id LIMIT 10")
def top_rows(spark, sf):
    out = rel.top_rows(stats.residuals(predicted(spark, sf), "y"), 10, F.desc("abs_error"), c("row_id"))
    return out.select("row_id", F.round("abs_error", 4).alias("abs_error"))


@query("union_parts_e8", f"{CLEAN} SELECT idx, 'new' AS part FROM clean WHERE kilometros <= 1000 UNION ALL SELECT idx, 'used' FROM clean WHERE kilometros > 1000")
def union_parts(spark, sf):
    df = cleaned(spark, sf)
    new, used = df.where("kilometros <= 1000"), df.where("kilometros > 1000")
    return (new.select("idx", F.lit("new").alias("part"))
            .unionByName(used.select(F.lit("used").alias("part"), "idx")))


@query("append_columns_e9", f"{L} SELECT idx, precio, round(ln(1 + precio), 8) AS log_price, length(titulo) AS title_length FROM listings")
def append_columns(spark, sf):
    return listings(spark, sf).withColumns({
        "log_price": F.round(F.log1p("precio"), 8), "title_length": F.length("titulo").cast("bigint"),
    }).select("idx", "precio", "log_price", "title_length")


@query("set_difference_e10", f"{LC} SELECT DISTINCT marca AS brand, modelo AS model FROM listings EXCEPT SELECT brand, model FROM catalogue WHERE version IS NOT NULL")
def set_difference(spark, sf):
    listed = listings(spark, sf).select(c("marca").alias("brand"), c("modelo").alias("model"))
    return listed.subtract(catalogue(spark, sf).where("version is not null").select("brand", "model"))


@query("residuals_j9", f"{_PRED} SELECT row_id, split, round(e, 4) AS residual, round(abs(e), 4) AS abs_error FROM pred")
def residuals(spark, sf):
    out = stats.residuals(predicted(spark, sf), "y")
    return out.select("row_id", "split", F.round("residual", 4).alias("residual"), F.round("abs_error", 4).alias("abs_error"))
