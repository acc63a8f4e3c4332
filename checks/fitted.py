"""Fitted steps over the cleaned listing view, fitted on its training part."""

from pyspark.sql import functions as F

from checks import query
from checks import fixture as fx
from checks.fixture import CLEAN, HASH, L, SPLIT, listings, near, plain, raw, sql_near
from checks.profile import cleaned
from lotwise.operators import encoders as enc, impute, strata
from lotwise.plans.clean import clean_by_version
from lotwise.session import materialize

c = F.col


def parts(spark, sf, *columns):
    """Cleaned listings (all columns, or the named ones beside idx and split), written once: every fit and transform starts here."""
    by_version = not columns or "version" in columns
    rows = enc.hash_split(plain(clean_by_version(raw(spark, sf))) if by_version else cleaned(spark, sf), "idx")
    return materialize(rows.select("idx", "split", *columns) if columns else rows, "parts")


def fitted(step, spark, sf, *columns):
    df = parts(spark, sf, *columns)
    return step.fit(df.where("split = 'train'")).transform(df)


@query("hash_split_i18", f"{SPLIT} SELECT idx, split FROM parts")
def split(spark, sf):
    return enc.hash_split(listings(spark, sf), "idx").select("idx", "split")


@query("stratified_split_i18", f"""{L}, h AS (SELECT idx, modelo, cast('0x' || substr(md5(concat(idx, '|42')), 1, 15) as bigint) AS h FROM listings),
  r AS (SELECT idx, modelo, row_number() OVER (PARTITION BY modelo ORDER BY h) AS rn, count(*) OVER (PARTITION BY modelo) AS n FROM h) SELECT idx, modelo, rn <= ceil(0.2::DOUBLE * n) AS is_test FROM r""")
def split_strata(spark, sf):
    return strata.stratified_split(listings(spark, sf).select("idx", "modelo"), "idx", ["modelo"])


@query("exact_split_i18", f"""{L}, h AS (SELECT idx, cast('0x' || substr(md5(concat(idx, '|42')), 1, 15) as bigint) AS h FROM listings),
  r AS (SELECT idx, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM h) SELECT idx, rn <= ceil(0.2 * n) AS is_test FROM r""")
def split_exact(spark, sf):
    return enc.exact_split(listings(spark, sf).select("idx"), "idx")


@query("smoothed_target_mean_i9", f"""{SPLIT}, train AS (SELECT * FROM parts WHERE split = 'train'), g AS (SELECT avg(precio) AS g FROM train),
  m AS (SELECT marca, (count(precio) * avg(precio) + 10.0::DOUBLE * max(g)) / (count(precio) + 10) AS code FROM train, g GROUP BY marca),
  v AS (SELECT version, (count(precio) * avg(precio) + 10.0::DOUBLE * max(g)) / (count(precio) + 10) AS code FROM train, g WHERE version IS NOT NULL GROUP BY version)
  SELECT idx, split, {sql_near('coalesce(m.code, g)')} AS marca, {sql_near('coalesce(v.code, g)')} AS version
  FROM parts p CROSS JOIN g LEFT JOIN m ON p.marca = m.marca LEFT JOIN v ON p.version = v.version""")
def smoothed(spark, sf):
    out = fitted(enc.TargetMean(["marca", "version"], "precio"), spark, sf, "marca", "version", "precio")
    return out.select("idx", "split", near("marca").alias("marca"), near("version").alias("version"))


@query("plain_target_mean_i10", f"""{SPLIT}, m AS (SELECT modelo, color, avg(precio) AS code FROM parts WHERE split = 'train' GROUP BY GROUPING SETS ((modelo), (color)))
  SELECT idx, split, {sql_near('a.code')} AS modelo, {sql_near('b.code')} AS color FROM parts p
  LEFT JOIN m a ON a.modelo = p.modelo AND a.color IS NULL LEFT JOIN m b ON b.color = p.color AND b.modelo IS NULL""")
def plain_mean(spark, sf):
    out = fitted(enc.TargetMean(["modelo", "color"], "precio", smoothing=None), spark, sf, "modelo", "color", "precio")
    return out.select("idx", "split", near("modelo").alias("modelo"), near("color").alias("color"))


@query("standardize_i11", f"""{SPLIT}, s AS (SELECT avg(kilometros) AS k, stddev_pop(kilometros) AS ks, avg(cv) AS c, stddev_pop(cv) AS cs FROM parts WHERE split = 'train')
  SELECT idx, round((kilometros - k) / ks, 6) AS kilometros, round((cv - c) / cs, 6) AS cv FROM parts, s""")
def standardize(spark, sf):
    out = fitted(enc.Standardize(["kilometros", "cv", "absent"]), spark, sf, "kilometros", "cv")
    return out.select("idx", F.round("kilometros", 6).alias("kilometros"), F.round("cv", 6).alias("cv"))


@query("one_hot_i15", f"""{SPLIT} SELECT idx, coalesce(CAST(combustible = 'Diésel' AS INT), 0) AS diesel, coalesce(CAST(combustible = 'Híbrido' AS INT), 0) AS hibrido,
  coalesce(CAST(combustible = 'Nafta' AS INT), 0) AS nafta, 0 AS sin_ver, CAST(vendedor = 'Concesionaria' AS INT) AS agencia, CAST(vendedor = 'Particular' AS INT) AS particular FROM parts""")
def one_hot(spark, sf):
    out = fitted(enc.OneHot(["combustible", "vendedor"]), spark, sf, "combustible", "vendedor")
    names = {"combustible_Diésel": "diesel", "combustible_Híbrido": "hibrido", "combustible_Nafta": "nafta",
             "combustible_Unknown": "sin_ver", "vendedor_Concesionaria": "agencia", "vendedor_Particular": "particular"}
    return out.select("idx", *[c(f"`{k}`").alias(v) for k, v in names.items()])


@query("dummies_i16", f"""{SPLIT} SELECT idx, CAST(transmision = 'Automática' AS INT) AS automatica, CAST(transmision = 'Manual' AS INT) AS manual FROM parts WHERE split = 'validation'""")
def dummies(spark, sf):
    out = fitted(enc.OneHot(["transmision"], unknown=False), spark, sf, "transmision").where("split = 'validation'")
    return out.select("idx", c("`transmision_Automática`").alias("automatica"), c("transmision_Manual").alias("manual"))


@query("ordinal_code_i17", f"""{SPLIT}, o AS (SELECT color, row_number() OVER (ORDER BY encode(color)) - 1 AS code FROM (SELECT DISTINCT color FROM parts WHERE split = 'train' AND color IS NOT NULL) t)
  SELECT idx, CASE WHEN p.color IS NOT NULL THEN CAST(coalesce(o.code, -1) AS DOUBLE) END AS color FROM parts p LEFT JOIN o ON p.color = o.color""")
def ordinal(spark, sf):
    return fitted(enc.OrdinalCode(["color"]), spark, sf, "color").select("idx", "color")


@query("fill_version_i7", f"""{SPLIT}, n AS (SELECT marca, modelo, version, count(*) AS n FROM parts WHERE split = 'train' AND version IS NOT NULL GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo ORDER BY n DESC, version) AS rn FROM n)
  SELECT idx, coalesce(p.version, r.version) AS version FROM parts p LEFT JOIN r ON p.marca = r.marca AND p.modelo = r.modelo AND rn = 1""")
def fill_version(spark, sf):
    out = fitted(impute.FillVersion("version", "marca", "modelo"), spark, sf, "marca", "modelo", "version")
    return out.select("idx", "version")


def _levels(x):
    out = []
    for name, keys in (("l3", "marca, modelo, version"), ("l2", "marca, modelo"), ("l1", "marca"), ("l0", "")):
        group = f"{keys}, {x}" if keys else x
        where = " AND ".join([f"{k} IS NOT NULL" for k in group.split(", ")])
        over = f"PARTITION BY {keys} " if keys else ""
        out.append(f"{name}_{x} AS (SELECT {group} FROM (SELECT {group}, row_number() OVER ({over}ORDER BY count(*) DESC, {x}) AS rn "
                   f"FROM parts WHERE split = 'train' AND {where} GROUP BY {group}) t WHERE rn = 1)")
    return ", ".join(out)


def _filled(x):
    return f"coalesce(p.{x}, l3_{x}.{x}, l2_{x}.{x}, l1_{x}.{x}, (SELECT {x} FROM l0_{x})) AS {x}"


def _level_joins(x):
    return (f"LEFT JOIN l3_{x} ON p.marca = l3_{x}.marca AND p.modelo = l3_{x}.modelo AND p.version = l3_{x}.version "
            f"LEFT JOIN l2_{x} ON p.marca = l2_{x}.marca AND p.modelo = l2_{x}.modelo LEFT JOIN l1_{x} ON p.marca = l1_{x}.marca")


_FILLED = ("cv", "motor", "traccion")


@query("fill_from_hierarchy_i8", f"{SPLIT}, {', '.join(map(_levels, _FILLED))} SELECT idx, {', '.join(map(_filled, _FILLED))} FROM parts p {' '.join(map(_level_joins, _FILLED))}")
def fill_hierarchy(spark, sf):
    step = impute.FillFromHierarchy(["cv", "motor", "traccion"], ["marca", "modelo", "version"])
    return fitted(step, spark, sf, "marca", "modelo", "version", "cv", "motor", "traccion").select("idx", "cv", "motor", "traccion")
