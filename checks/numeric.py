"""Imputation from neighbours, outliers, embeddings, colours and vectors."""

from pyspark.sql import functions as F

from checks import query
from checks.fixture import CLEAN, L, SPLIT, listings, table
from checks.fitted import fitted, parts
from checks.profile import version_counts
from lotwise.functions.text import ascii_words_squeezed
from lotwise.operators import colours, embed, linkage, neighbours, outliers, similarity as sim

c = F.col
_COLS = ("kilometros", "cv", "motor", "anio")


def _knn_sql():
    gap = " + ".join(f"CASE WHEN r.{x} IS NOT NULL AND d.{x} IS NOT NULL THEN (r.{x} - d.{x}) * (r.{x} - d.{x}) ELSE 0 END" for x in _COLS)
    shared = " + ".join(f"CAST(r.{x} IS NOT NULL AND d.{x} IS NOT NULL AS INT)" for x in _COLS)
    key, rkey = ", ".join(_COLS), ", ".join(f"r.{x} AS r_{x}" for x in _COLS)
    parts_ = [f"""{SPLIT}, v AS (SELECT idx, split, kilometros / 1000 AS kilometros, CAST(cv AS DOUBLE) AS cv, motor * 10 AS motor, CAST(anio AS DOUBLE) AS anio FROM parts),
  d AS (SELECT {key}, count(*) AS w FROM v WHERE split = 'train' GROUP BY ALL), r AS (SELECT DISTINCT {key} FROM v WHERE ({' + '.join(_COLS)}) IS NULL),
  m AS (SELECT {', '.join(f'avg({x}) AS {x}' for x in _COLS)} FROM v WHERE split = 'train')"""]
    for x in _COLS:
        order = "d2, " + ", ".join(f"{y} NULLS FIRST" for y in _COLS)
        parts_.append(f"""n_{x} AS (SELECT {rkey}, d.*, ({gap}) * 4.0 / ({shared}) AS d2 FROM r JOIN d ON r.{x} IS NULL AND d.{x} IS NOT NULL AND ({shared}) > 0),
  o_{x} AS (SELECT *, sum(w) OVER (PARTITION BY {', '.join('r_' + y for y in _COLS)} ORDER BY {order} ROWS UNBOUNDED PRECEDING) - w AS before FROM n_{x}),
  f_{x} AS (SELECT {', '.join('r_' + y for y in _COLS)}, sum(least(w, 5 - before) * {x})::DOUBLE / sum(least(w, 5 - before))::DOUBLE AS f FROM o_{x} WHERE before < 5 GROUP BY {', '.join('r_' + y for y in _COLS)})""")
    joins = " ".join(f"LEFT JOIN f_{x} ON " + " AND ".join(f"f_{x}.r_{y} IS NOT DISTINCT FROM v.{y}" for y in _COLS) for x in _COLS)
    return ", ".join(parts_) + " SELECT idx, " + ", ".join(f"round(coalesce(v.{x}, f_{x}.f, m.{x}), 6) AS {x}" for x in _COLS) + f" FROM v CROSS JOIN m {joins}"


@query("knn_impute_i12_c10", _knn_sql())
def knn(spark, sf):
    df = parts(spark, sf, *_COLS).select("idx", "split", (c("kilometros") / 1000).alias("kilometros"), c("cv").cast("double").alias("cv"),
                                 (c("motor") * 10).alias("motor"), c("anio").cast("double").alias("anio"))
    out = neighbours.KnnImputer(list(_COLS)).fit(df.where("split = 'train'")).transform(df)
    return out.select("idx", *[F.round(x, 6).alias(x) for x in _COLS])


@query("isolation_forest_i13")
def isolation(spark, sf):
    df = parts(spark, sf, "precio")
    return outliers.IsolationForest(["precio"], key="idx").fit(df.where("split = 'train'")).transform(df)


@query("percentile_cut_i14", f"""{SPLIT} SELECT idx, kilometros FROM parts WHERE kilometros IS NULL OR kilometros <= (SELECT quantile_cont(kilometros, 0.9) FROM parts WHERE split = 'train')""")
def percentile_cut(spark, sf):
    return fitted(outliers.PercentileCut("kilometros"), spark, sf, "kilometros").select("idx", "kilometros")


@query("description_scores_i6")
def description_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = embed.DescriptionScores(text="text").fit(docs.where("doc_id % 5 <> 0")).transform(docs)
    return out.select("doc_id", *[F.round(f"embed_{j}", 6).alias(f"embed_{j}") for j in range(1, 6)])


@query("linkage_clusters_i4")
def linkage_clusters(spark, sf):
    df = version_counts(spark, sf).groupBy("marca", "modelo", "version").agg(F.sum("n").alias("n"))
    return linkage.linkage_labels(df.withColumn("text", ascii_words_squeezed(c("version"))), ["marca", "modelo"], "version")


@query("base_colour_i19")
def base_colour(spark, sf):
    return colours.to_base_colour(listings(spark, sf).select("idx", "color"), "color", "base")


@query("colour_groups_i20")
def colour_groups(spark, sf):
    return colours.to_colour_group(listings(spark, sf).select("idx", "color"), "color", "grupo")


@query("nearest_frequent_value_i21_c9", """WITH used AS (SELECT o_orderkey, o_custkey % 700 AS value FROM orders), n AS (SELECT value, count(*) AS n FROM used GROUP BY value),
  top AS (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS place FROM n QUALIFY place <= 16), e AS (SELECT vec_id AS value, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  s AS (SELECT n.value, t.value AS target, row_number() OVER (PARTITION BY n.value ORDER BY round(list_cosine_similarity(a.v, b.v), 9) DESC, t.place) AS rn
    FROM n JOIN e a ON a.value = n.value JOIN top t ON true JOIN e b ON b.value = t.value)
  SELECT o_orderkey, CASE WHEN u.value IN (SELECT value FROM top) THEN u.value ELSE coalesce(s.target, (SELECT value FROM top WHERE place = 1)) END AS value FROM used u LEFT JOIN s ON s.value = u.value AND rn = 1""")
def nearest_frequent(spark, sf):
    used = table(spark, sf, "orders").select("o_orderkey", (c("o_custkey") % 700).alias("value"))
    vectors = table(spark, sf, "embeddings").select(c("vec_id").alias("value"), c("embedding").alias("vector"))
    return colours.to_frequent_value(used, "value", vectors, "value")


@query("vector_summary_i22", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), f AS (SELECT label, arg_min(v, vec_id) AS head FROM e GROUP BY label)
  SELECT vec_id, round(list_min(v), 6) AS lowest, round(list_max(v), 6) AS highest, round(sqrt(list_inner_product(v, v)), 6) AS length, round(list_cosine_similarity(v, head), 6) AS to_first FROM e JOIN f USING (label)""")
def vector_summary(spark, sf):
    df = table(spark, sf, "embeddings")
    heads = df.groupBy("label").agg(F.min(F.struct("vec_id", "embedding")).alias("h")).select("label", c("h.embedding").alias("head"))
    out = sim.vector_summary(df, "embedding").join(heads, "label")
    return out.select("vec_id", *[F.round(x, 6).alias(x) for x in ("lowest", "highest", "length")],
                      F.round(sim.cosine(c("embedding"), c("head")), 6).alias("to_first"))
