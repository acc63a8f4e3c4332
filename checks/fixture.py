"""Listing and catalogue views over the given tables (same text in both engines)."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import fixed_values as fx
from lotwise.session import spread

LISTINGS_TEXT = """
WITH base AS (
  SELECT l.*, p.p_name, p.p_brand, p.p_type,
         l.l_orderkey + l.l_partkey + l.l_linenumber AS k
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT concat(CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20)), '-', CAST(l_partkey AS VARCHAR(20)), '-', CAST(l_suppkey AS VARCHAR(20)), '-', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20))) AS idx,
  p_brand AS marca, p_type AS modelo,
  CASE WHEN k % 11 = 0 THEN NULL ELSE concat(
    CAST(k % 3 + 1 AS VARCHAR(20)), CASE WHEN k % 4 = 0 THEN ',' ELSE '.' END, CAST(k % 10 AS VARCHAR(20)),
    CASE WHEN k % 7 = 0 THEN 'T' ELSE '' END, ' ',
    CASE WHEN k % 2 = 0 THEN upper(p_name) ELSE p_name END,
    CASE k % 5 WHEN 0 THEN ' 4x4' WHEN 1 THEN ' AWD' WHEN 2 THEN ' 4X2' ELSE '' END,
    CASE k % 6 WHEN 0 THEN ' 6AT' WHEN 1 THEN ' cvt' ELSE '' END,
    CASE WHEN k % 8 = 0 THEN concat(' ', CAST(90 + k % 90 AS VARCHAR(20)), 'cv') ELSE '' END) END AS version,
  concat(p_brand, ' ', p_type, ' ', p_name) AS titulo,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 'TURBOALIMENTADO' WHEN k % 3 = 1 THEN '1.6' ELSE '2,0 TSI' END AS motor,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 4 = 0 THEN '0' ELSE concat(CAST(k % 200 AS VARCHAR(20)), '.000 km') END AS kilometros,
  l_extendedprice AS precio,
  CASE WHEN k % 5 = 0 THEN 'US$' ELSE '$' END AS moneda,
  CASE WHEN k % 19 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'Nafta' WHEN l_returnflag = 'N' THEN 'Diésel' ELSE 'Híbrido' END AS combustible,
  CASE WHEN k % 2 = 0 THEN 'Automática' ELSE 'Manual' END AS transmision,
  CASE WHEN l_linestatus = 'O' THEN 'Concesionaria' ELSE 'Particular' END AS vendedor,
  CASE k % 7 WHEN 0 THEN 'Blanca' WHEN 1 THEN 'NEGRO' WHEN 2 THEN 'gris plata' WHEN 3 THEN 'Azúl' WHEN 4 THEN 'roja ' WHEN 5 THEN 'marrón' ELSE NULL END AS color,
  CASE WHEN k % 3 = 0 THEN 1.0E0 ELSE NULL END AS camara,
  2015 + k % 10 AS anio,
  CASE k % 9 WHEN 0 THEN 'El precio publicado es anticipo, saldo en cuotas' WHEN 1 THEN 'Tiene un golpe en el paragolpes, a reparar' WHEN 2 THEN 'Anticipo y plan de 36 cuotas. Motor 150 hp' WHEN 3 THEN NULL ELSE 'Impecable, único dueño' END AS descripcion
FROM base
"""

CATALOGUE_TEXT = """
SELECT DISTINCT p_brand AS brand, p_type AS model,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat(upper(substring(p_name, 1, 1)), substring(p_name, 2)) END AS version
FROM part
"""

LISTING_NAMES = {
    "marca": fx.BRAND, "modelo": fx.MODEL, "version": fx.VERSION, "titulo": fx.TITLE,
    "motor": fx.ENGINE, "kilometros": fx.KM, "precio": fx.PRICE, "moneda": fx.CURRENCY,
    "combustible": fx.FUEL, "transmision": fx.GEARBOX, "vendedor": fx.SELLER, "color": fx.COLOUR,
    "camara": fx.CAMERA, "anio": fx.YEAR, "descripcion": fx.TEXT,
}
PLAIN_NAMES = {full: plain for plain, full in LISTING_NAMES.items()} | {
    fx.TURBO: "turbo", fx.TRACTION: "traccion", fx.DOWN_PAYMENT: "anticipo"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """The listing view under its short column names."""
    text = LISTINGS_TEXT.replace("FROM lineitem l JOIN part p", "FROM {lineitem} l JOIN {part} p")
    return spark.sql(text, lineitem=spread(table(spark, sf, "lineitem")), part=table(spark, sf, "part"))


def named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(LISTING_NAMES)


def plain(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PLAIN_NAMES)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """The listing view under the library's column names."""
    return named(listings(spark, sf))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    text = CATALOGUE_TEXT.replace("FROM part", "FROM {part}")
    return spark.sql(text, part=table(spark, sf, "part"))


# ---------------------------------------------------------------- SQL side
L = f"WITH listings AS ({LISTINGS_TEXT})"
LC = f"{L}, catalogue AS ({CATALOGUE_TEXT})"

NUM = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def sql_number(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, {NUM}) THEN try_cast(trim({c}) AS DOUBLE) END)"


def sql_engine_size(c: str) -> str:
    return (f"try_cast(replace(coalesce(nullif(regexp_extract({c}, '\\b(\\d\\.\\d)\\b', 1), ''), "
            f"nullif(regexp_extract({c}, '\\b(\\d,\\d)\\b', 1), '')), ',', '.') AS DOUBLE)")


def sql_km(c: str) -> str:
    return (f"coalesce({sql_number(c)}, CASE WHEN {c} LIKE '% km' THEN "
            + sql_number(f"replace(replace({c}, ' km', ''), '.', '')") +
            f" ELSE try_cast(nullif(regexp_extract(replace({c}, '.', ''), '(\\d+)', 1), '') AS DOUBLE) END)")


def sql_motor(motor: str, version: str) -> str:
    return (f"CASE WHEN {motor} IS NOT NULL THEN coalesce({sql_number(motor)}, "
            f"{sql_engine_size(motor)}, {sql_engine_size(version)}) END")


def sql_turbo(motor: str, version: str) -> str:
    return (f"CAST(regexp_matches(coalesce({motor}, 'nan') || ' ' || coalesce({version}, 'nan'), "
            f"'(?i)turbo|\\d[\\.,]?\\d?\\s*t|tsi|tfsi') AS INT)")


def sql_cv(*texts: str) -> str:
    parts = ", ".join(f"nullif(regexp_extract({t}, '(?i)(\\d+)\\s*(cv|hp)\\b', 1), '')" for t in texts)
    return f"try_cast(coalesce({parts}) AS BIGINT)"


def sql_traction(v: str) -> str:
    return (f"CASE WHEN regexp_matches({v}, '(?i)4x4|4wd|awd') THEN '4x4' "
            f"WHEN regexp_matches({v}, '(?i)4x2|2wd|fwd') THEN '4x2' END")


def sql_squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


def sql_drop_engine(c: str) -> str:
    once = f"regexp_replace({c}, '(^|\\s)(\\d[.,]\\d)\\s*[Ll]?(\\s|$|\\W)', ' \\3', 'g')"
    twice = f"regexp_replace({once}, '(^|\\s)(\\d[.,]\\d)\\s*[Ll]?(\\s|$|\\W)', ' \\3', 'g')"
    t = f"regexp_replace({twice}, '\\b\\d[.,]?\\d?\\s*[tT]\\b', ' ', 'g')"
    return sql_squeeze(f"regexp_replace({t}, '(?i)\\b(TSI|TFSI|TURBO)\\b', ' ', 'g')")


def sql_drop_gearbox(c: str) -> str:
    one = f"regexp_replace({c}, '(?i)\\b\\d*\\s*(at|mt|dct|cvt)\\d*\\b', '', 'g')"
    return sql_squeeze(f"regexp_replace({one}, '(?i)\\b(at|mt|dct|cvt|automática|manual)\\b', '', 'g')")


def sql_drop_power(c: str) -> str:
    return f"trim(replace(regexp_replace({c}, '(?i)\\b\\d+\\s*(cv|hp)\\b', '', 'g'), '  ', ' '))"


def sql_drop_traction(c: str) -> str:
    return sql_squeeze(f"regexp_replace({c}, '(?i)\\b(4x[24]|awd|4wd|2wd|fwd)\\b', '', 'g')")


def sql_drop_value(c: str, value: str) -> str:
    return (f"CASE WHEN {value} IS NULL OR lower({value}) IN ('', 'nan') THEN {c} ELSE "
            f"regexp_replace({c}, '\\b' || regexp_escape(lower({value})) || '\\b', '', 'g') END")


def sql_drop_words(c: str, fuel="combustible", brand="marca", model="modelo") -> str:
    out = f"lower({c})"
    for value in (fuel, brand, model):
        out = sql_drop_value(out, value)
    out = f"regexp_replace({out}, '\\b(nafta|gasolina|diesel|gnc|gas|híbrido|eléctrico)\\b', '', 'g')"
    out = f"regexp_replace({out}, '\\b(suv|sedan|hatchback|pickup|coupe|convertible)\\b', '', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


# cleaned listings: the stages of the version text are separate CTEs to keep the text short
CLEAN = f"""{L},
v1 AS (SELECT *, {sql_drop_engine('version')} AS s1 FROM listings),
v2 AS (SELECT *, {sql_drop_gearbox('s1')} AS s2 FROM v1),
v3 AS (SELECT *, {sql_drop_power('s2')} AS s3 FROM v2),
v4 AS (SELECT *, {sql_drop_traction('s3')} AS s4 FROM v3),
v5 AS (SELECT *, {sql_drop_words('s4')} AS s5 FROM v4),
t0 AS (SELECT *, trim(regexp_replace({sql_drop_value(sql_drop_value('lower(titulo)', 'marca'), 'modelo')}, '\\s+', ' ', 'g')) AS b0 FROM v5),
t1 AS (SELECT *, {sql_drop_engine('b0')} AS b1 FROM t0),
t2 AS (SELECT *, {sql_drop_gearbox('b1')} AS b2 FROM t1),
t3 AS (SELECT *, {sql_drop_power('b2')} AS b3 FROM t2),
t4 AS (SELECT *, {sql_drop_traction('b3')} AS b4 FROM t3),
t5 AS (SELECT *, nullif({sql_drop_words('b4')}, '') AS b5 FROM t4),
clean AS (
  SELECT idx, marca, modelo, CASE WHEN s5 = '' THEN b5 ELSE s5 END AS version, titulo,
    {sql_motor('motor', 'version')} AS motor, {sql_km('kilometros')} AS kilometros, precio, moneda,
    combustible, transmision, vendedor, color, coalesce(camara, 0) AS camara, anio, descripcion,
    {sql_turbo('motor', 'version')} AS turbo, {sql_cv('version', 'titulo', 'descripcion')} AS cv,
    {sql_traction('version')} AS traccion,
    CASE WHEN {sql_km('kilometros')} <= 0 AND (
      regexp_matches(lower(descripcion), '(precio|valor|importe)\\s+(publicado|expresado|es)\\s+(un\\s+)?anticipo|precio\\s+de\\s+anticipo|precio\\s+publicado\\s+.*anticipo')
      OR (contains(lower(descripcion), 'anticipo')
          AND regexp_matches(lower(descripcion), 'cuota|financi|resto|tasa|plan|mínimo|minimo')))
    THEN 1 ELSE 0 END AS anticipo
  FROM t5)"""

HASH = "cast('0x' || substr(md5(concat(idx, '|42')), 1, 8) as bigint)"
SPLIT = f"""{CLEAN},
parts AS (SELECT *, CASE WHEN {HASH} % 100 < 20 THEN 'test' WHEN {HASH} // 100 % 100 < 20 THEN 'validation' ELSE 'train' END AS split FROM clean)"""


# Means of a few prices often end exactly between two roundings; a small shift keeps both engines on one side.
def near(column, digits: int = 4):
    return F.round(F.col(column) + 3.17e-6 if isinstance(column, str) else column + 3.17e-6, digits)


def sql_near(expression: str, digits: int = 4) -> str:
    return f"round({expression} + 3.17e-6, {digits})"
