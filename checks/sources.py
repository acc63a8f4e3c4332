"""Scans, sinks and nested data derived from the given tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import query
from checks.fixture import CATALOGUE_TEXT, L, catalogue, listings, table
from lotwise.operators import stats
from lotwise.sources import cars, files, infer, labels, pages, runs
from lotwise.session import scratch_path

c = F.col


@query("csv_round_trip_a1_a4", f"{L} SELECT idx, marca, version, kilometros, precio, color, camara, CAST(anio AS BIGINT) AS anio, descripcion FROM listings")
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    columns = ["idx", "marca", "version", "kilometros", "precio", "color", "camara", "anio", "descripcion"]
    files.write_csv(listings(spark, sf).select(*columns), path)
    return files.read_csv(spark, path, StructType.fromDDL(
        "idx string, marca string, version string, kilometros string, precio double, color string, camara double, anio bigint, descripcion string"))


def untyped_files(spark, sf):
    """Order lines in CSV files of two forms, with other columns in another order."""
    path = scratch_path(spark, "untyped")
    rows = table(spark, sf, "lineitem")
    mixed = F.when(c("l_orderkey") % 2 == 0, c("l_linenumber").cast("string")).otherwise(c("l_returnflag"))
    amount = F.when(c("l_orderkey") % 5 == 0, F.lit("N/A")).otherwise(c("l_quantity").cast("double").cast("string"))
    one = rows.where("l_linenumber <= 3").select(
        c("l_orderkey").alias("order"), c("l_linenumber").alias("line"), c("l_partkey").alias("part"), amount.alias("amount"), mixed.alias("mixed"))
    other = rows.where("l_linenumber > 3").select(
        amount.alias("amount"), c("l_linenumber").alias("line"), c("l_orderkey").alias("order"), c("l_partkey").alias("part"),
        F.when(c("l_linestatus") == "O", "True").otherwise("False").alias("open, now"), F.lit("nan").alias("nothing"))
    for part in (one, other):
        part.write.mode("append").option("header", True).csv(path)
    return path


_UNTYPED = """WITH t AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS amount,
  CASE WHEN l_linenumber <= 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_linenumber AS VARCHAR) ELSE l_returnflag END END AS mixed,
  CASE WHEN l_linenumber > 3 THEN l_linestatus = 'O' END AS now FROM lineitem)"""


@query("csv_types_a1", f"""{_UNTYPED} SELECT CAST(o AS BIGINT) AS "order", CAST(n AS BIGINT) AS line, CAST(p AS BIGINT) AS part, amount, mixed, now AS open_now, CAST(NULL AS DOUBLE) AS nothing FROM t""")
def csv_types(spark, sf):
    return infer.infer_csv(spark, untyped_files(spark, sf)).withColumnRenamed("open, now", "open_now")


@query("csv_column_types_a1", f"""{_UNTYPED}, k AS (SELECT count(*) AS rows, count(amount) AS a, count(mixed) AS m, count(now) AS w FROM t)
  SELECT "column", type, filled, rows - filled AS missing FROM (SELECT 'order' AS "column", 'bigint' AS type, rows AS filled, rows FROM k UNION ALL SELECT 'line', 'bigint', rows, rows FROM k
  UNION ALL SELECT 'part', 'bigint', rows, rows FROM k UNION ALL SELECT 'amount', 'double', a, rows FROM k UNION ALL SELECT 'mixed', 'string', m, rows FROM k
  UNION ALL SELECT 'open, now', 'boolean', w, rows FROM k UNION ALL SELECT 'nothing', 'double', CAST(0 AS BIGINT), rows FROM k) u""")
def csv_column_types(spark, sf):
    return infer.found_types(infer.read_text_columns(spark, untyped_files(spark, sf))).drop("place")


@query("catalogue_scan_a2", f"WITH catalogue AS ({CATALOGUE_TEXT}) SELECT brand, model, version, CAST(length(version) AS BIGINT) AS quantity FROM catalogue WHERE version IS NOT NULL")
def catalogue_scan(spark, sf):
    path = scratch_path(spark, "catalogue")
    rows = catalogue(spark, sf).select(c("brand").alias("Brand"), c("model").alias("Model"),
                                       F.coalesce("version", F.lit("N/A")).alias("Version"), F.length("version").alias("Quantity"))
    files.write_csv(rows, path)
    return files.read_catalogue(spark, path)


def record_rows(spark, sf):
    """One nested record per part; parts of size 7 have no price."""
    part = table(spark, sf, "part")
    price = F.when(c("p_size") != 7, F.struct(F.lit("US$").alias("Moneda"), c("p_retailprice").alias("Importe")))
    record = F.struct(
        c("p_brand").alias("Marca"), c("p_type").alias("Modelo"), F.concat(c("p_name"), F.lit(" edición")).alias("Version"),
        F.when(c("p_size") % 2 == 0, "SUV").otherwise("Sedan").alias("Carroceria"), F.lit("C").alias("Segmento"),
        F.when(c("p_size") % 3 == 0, "nafta").otherwise("diesel").alias("Propulsion"), F.lit("Manual").alias("Transmision"),
        F.concat((c("p_size") + 90).cast("string"), F.lit(" cv")).alias("Potencia"),
        F.when(c("p_size") % 4 == 0, "1.6").otherwise("2.0").alias("Cilindrada"), F.lit("Brasil").alias("Origen"),
        (2015 + c("p_size") % 10).cast("string").alias("VersionYear"), price.alias("Precio"))
    return part.select("p_partkey", "p_size", (2015 + c("p_size") % 10).alias("year"), record.alias("record"))


def record_files(spark, sf):
    """``.json`` files of one record a line below year folders; records of size 9 have a price that is no object."""
    path = scratch_path(spark, "records")
    rows = record_rows(spark, sf)
    good = rows.where("p_size <> 9").select("record.*", "year")
    broken = rows.where("p_size = 9").select(c("p_partkey").cast("string").alias("Version"), F.lit("ask").alias("Precio"), "year")
    for part in (good, broken):
        part.write.mode("append").partitionBy("year").json(path)
    return path


@query("car_records_a3_b6", """SELECT p_brand AS "Marca", p_type AS "Modelo", p_name || ' edición' AS "Version", CAST(2015 + p_size % 10 AS VARCHAR) AS "VersionYear", 'SUV' AS "Carroceria", 'C' AS "Segmento",
  CASE WHEN p_size % 3 = 0 THEN 'nafta' ELSE 'diesel' END AS "Propulsion", 'Manual' AS "Transmision", (p_size + 90) || ' cv' AS "Potencia", CASE WHEN p_size % 4 = 0 THEN '1.6' ELSE '2.0' END AS "Cilindrada",
  'Brasil' AS "Origen", '' AS "Garantia", CASE WHEN p_size <> 7 THEN 'US$' ELSE '' END AS "Moneda", CASE WHEN p_size <> 7 THEN p_retailprice END AS "Importe" FROM part WHERE p_size <> 9 AND p_size % 2 = 0""")
def car_records(spark, sf):
    return cars.flatten_records(cars.read_records(spark, record_files(spark, sf), one_per_file=False))


@query("broken_records_a3", "SELECT CAST(p_partkey AS VARCHAR) AS version, CAST(2015 + p_size % 10 AS VARCHAR) AS year FROM part WHERE p_size = 9")
def broken_records(spark, sf):
    bad = cars.bad_records(spark, record_files(spark, sf), one_per_file=False)
    return bad.select(F.get_json_object("_corrupt_record", "$.Version").alias("version"),
                      F.regexp_extract("file", "year=([0-9]+)", 1).alias("year"))


@query("request_lines_a5", f"""{L} SELECT 'request-' || (row_id) AS custom_id, descripcion AS user_text, 2 AS messages, 500 AS max_tokens
  FROM (SELECT replace(idx, '-', '') AS row_id, descripcion FROM listings) t WHERE trim(descripcion) <> ''""")
def request_lines(spark, sf):
    df = listings(spark, sf).select(F.replace("idx", F.lit("-"), F.lit("")).alias("row_id"), "descripcion")
    path = scratch_path(spark, "requests")
    labels.write_requests(df, path, key="row_id", text="descripcion", instruction="Mark the kinds of damage the text names, as JSON.")
    r = F.from_json("value", "custom_id string, body struct<messages: array<struct<role: string, content: string>>, max_tokens: int>")
    return spark.read.text(path).select(r.alias("r")).select(
        "r.custom_id", c("r.body.messages")[1]["content"].alias("user_text"), F.size("r.body.messages").alias("messages"),
        c("r.body.max_tokens").alias("max_tokens"))


def response_rows(spark, sf):
    """Answers made from the labels; every seventh line is broken, every eleventh lacks a flag."""
    df = table(spark, sf, "labels")
    flags = F.to_json(F.struct(c("quality").alias("cosmetic_damage"), c("toxic").alias("functional_damage"),
                               F.when(c("doc_id") % 11 != 0, c("quality") * c("toxic")).alias("severe_damage")))
    message = F.struct(F.struct(flags.alias("content")).alias("message"))
    line = F.to_json(F.struct(F.concat(F.lit("request-"), "doc_id").alias("custom_id"),
                              F.struct(F.struct(F.array(message).alias("choices")).alias("body")).alias("response")))
    return df.select(F.when(c("doc_id") % 7 == 0, F.substring(line, 1, 40)).otherwise(line).alias("value"))


@query("response_lines_a6", """SELECT doc_id AS original_idx, quality AS cosmetic_damage, toxic AS functional_damage, quality * toxic AS severe_damage
  FROM labels WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0""")
def response_lines(spark, sf):
    path = scratch_path(spark, "responses")
    response_rows(spark, sf).write.text(path)
    return labels.read_responses(spark, path)


@query("rejected_lines_a6", "SELECT count(*) AS rejected FROM labels WHERE doc_id % 7 = 0 OR doc_id % 11 = 0")
def rejected(spark, sf):
    return labels.rejected_responses(response_rows(spark, sf)).agg(F.count("*").alias("rejected"))


@query("damage_summary_d12", """WITH r AS (SELECT doc_id, quality AS c, toxic AS f, quality * toxic AS s FROM labels WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0),
  t AS (SELECT count(*) AS rows, sum(c) AS c, sum(f) AS f, sum(s) AS s, sum(c | f | s) AS a FROM r)
  SELECT flag, CAST(n AS BIGINT) AS n, round_even(n * 100.0::DOUBLE / rows, 1) AS pct FROM (SELECT 'cosmetic_damage' AS flag, c AS n, rows FROM t UNION ALL SELECT 'functional_damage', f, rows FROM t
  UNION ALL SELECT 'severe_damage', s, rows FROM t UNION ALL SELECT 'any', a, rows FROM t) u""")
def damage_summary(spark, sf):
    return stats.flag_summary(labels.parse_responses(response_rows(spark, sf)), labels.FLAGS)


_LI = "<li class=\"ui-search-filter-container\">"


@query("filter_panel_a9", """WITH nav AS (SELECT page_id, regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1) AS ul FROM pages),
  li AS (SELECT page_id, unnest(regexp_extract_all(ul, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS link, unnest(regexp_extract_all(ul, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS name,
    unnest(range(0, len(regexp_extract_all(ul, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)))) AS place FROM nav)
  SELECT page_id, CAST(place AS INT) AS place, replace(replace(replace(name, '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS name, 'ver' AS title, link, '(' || (page_id % 90) || ')' AS results_qty FROM li""")
def filter_panel(spark, sf):
    """The pages' own navigation lists, dressed as a filter panel behind another panel, then parsed from the whole page."""
    html = F.replace("html", F.lit("<nav><ul>"), F.lit(
        '<div class="ui-search-filter-dl"><h3 class="ui-search-filter-dt-title">Color</h3><ul><li class="ui-search-filter-container"><a class="ui-search-link" href="/no">no</a></li></ul></div>'
        '<div class="ui-search-filter-dl"><h3 class="ui-search-filter-dt-title">Versiones</h3><ul>'))
    html = F.replace(html, F.lit("</ul></nav>"), F.lit("</ul></div>"))
    item = F.concat(F.lit(_LI + '<a class="ui-search-link" title="ver" href="$1"><span class="ui-search-filter-name">$2</span>'
                          '<span class="ui-search-filter-results-qty">('), (c("page_id") % 90).cast("string"), F.lit(")</span></a></li>"))
    html = F.regexp_replace(html, F.lit('<li><a href="([^"]*)">([^<]*)</a></li>'), item)
    return pages.extract_panels(table(spark, sf, "pages").select("page_id", html.alias("html")), "Versiones")


@query("nested_catalogue_a10", """SELECT brand, model, version, quantity FROM (
  SELECT p_brand AS brand, CASE WHEN p_size % 5 = 0 THEN 'N/A' ELSE p_type END AS model, CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 'N/A' ELSE p_name END AS version,
    CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 0 ELSE CAST(p_size AS BIGINT) END AS quantity FROM part
  UNION ALL SELECT p_brand, p_type, p_name || ' plus', 0 FROM part WHERE p_size % 5 <> 0 AND p_size % 7 <> 0) t""")
def nested_catalogue(spark, sf):
    version = "array<struct<name: string, results_qty: string>>"
    versions = F.array(F.struct(c("p_name").alias("name"), F.concat(F.lit("("), c("p_size").cast("string"), F.lit(" resultados)")).alias("results_qty")),
                       F.struct(F.concat(c("p_name"), F.lit(" plus")).alias("name"), F.lit(None).cast("string").alias("results_qty")))
    models = F.array(F.struct(c("p_type").alias("name"), F.when(c("p_size") % 7 != 0, versions).otherwise(F.array().cast(version)).alias("versions")))
    nested = table(spark, sf, "part").select(c("p_brand").alias("brand_name"), F.when(c("p_size") % 5 != 0, models).alias("models"))
    return pages.sort_catalogue(pages.flatten_catalogue(nested))


@query("match_answers_a11", """WITH t AS (SELECT p_partkey, p_size % 3 = 0 AS m, p_brand, p_type, p_name, p_size % 4 AS n FROM part)
  SELECT p_partkey, m AS is_match, CASE WHEN m THEN 0 ELSE CAST(i AS INT) END AS place, p_brand AS brand, p_type AS model,
    CASE WHEN m THEN p_name WHEN i IS NULL THEN 'N/A' ELSE p_name || ' ' || i END AS version, CASE WHEN m THEN 'nafta' ELSE 'N/A' END AS fuel
  FROM t LEFT JOIN (SELECT unnest([1, 2, 3]) AS i) k ON NOT m AND i <= n""")
def match_answers(spark, sf):
    part = table(spark, sf, "part")
    match = F.when(c("p_size") % 3 == 0, F.struct(c("p_brand").alias("Marca"), c("p_type").alias("Modelo"), c("p_name").alias("Nombre"), F.lit("nafta").alias("Propulsion")))
    some = F.when(c("p_size") % 4 > 0, F.transform(F.sequence(F.lit(1), c("p_size") % 4), lambda i: F.struct(
        c("p_brand").alias("Marca"), c("p_type").alias("Modelo"), F.concat_ws(" ", "p_name", i.cast("string")).alias("Nombre"))))
    text = F.to_json(F.struct(match.alias("Match"), c("p_brand").alias("Make"), c("p_type").alias("Model"), some.alias("Candidates")))
    answers = part.select("p_partkey", F.from_json(text, cars.ANSWER).alias("answer"))
    return cars.flatten_answers(answers).select("p_partkey", "is_match", "place", "brand", "model", "version", "fuel")


_REC = """rec AS (SELECT p_partkey AS record_id, p_brand AS make, p_type AS model, p_name AS trim, CAST(2015 + p_size % 10 AS VARCHAR) AS year, CASE WHEN p_size % 3 = 0 THEN 'nafta' ELSE 'diesel' END AS fuel FROM part),
  req AS (SELECT DISTINCT p_brand AS make, p_type AS model, lower(p_name) AS trim, CASE WHEN p_size % 2 = 0 THEN CAST(2015 + p_size % 10 AS VARCHAR) END AS year, CASE WHEN p_size % 5 = 0 THEN 'nafta' END AS fuel FROM part)"""


@query("record_candidates_c11", f"""WITH {_REC}, pairs AS (SELECT concat_ws('|', q.make, q.model, q.trim, coalesce(q.year, ''), coalesce(q.fuel, '')) AS request_id, r.record_id FROM req q JOIN rec r ON r.make = q.make AND r.model = q.model
    AND (q.year IS NULL OR q.year = r.year) AND (q.fuel IS NULL OR q.fuel = r.fuel))
  SELECT request_id, record_id, count(*) OVER (PARTITION BY request_id) = 1 AS is_match FROM pairs""")
def record_candidates(spark, sf):
    part = table(spark, sf, "part")
    none = F.lit(None).cast("string")
    rest = [none.alias(x) for x in ("bodystyle", "transmission", "displacement", "power")]
    year = (2015 + c("p_size") % 10).cast("string")
    records = part.select(c("p_partkey").alias("record_id"), c("p_brand").alias("make"), c("p_type").alias("model"), c("p_name").alias("trim"),
                          year.alias("year"), F.when(c("p_size") % 3 == 0, "nafta").otherwise("diesel").alias("fuel"), *rest)
    asked = part.select(c("p_brand").alias("make"), c("p_type").alias("model"), F.lower("p_name").alias("trim"), F.when(c("p_size") % 2 == 0, year).alias("year"),
                        F.when(c("p_size") % 5 == 0, "nafta").alias("fuel"), *rest).distinct()
    asked = asked.withColumn("request_id", F.concat_ws("|", "make", "model", "trim", F.coalesce("year", F.lit("")), F.coalesce("fuel", F.lit(""))))
    return cars.find_versions(asked, records).select("request_id", "record_id", "is_match")


@query("run_table_a8", """SELECT 'brand_mean' AS run_name, p_type AS part, round(avg(p_retailprice), 4) AS value FROM part GROUP BY p_type""")
def run_table(spark, sf):
    path = scratch_path(spark, "runs")
    metrics = {r["p_type"]: r["m"] for r in table(spark, sf, "part").groupBy("p_type").agg(F.avg("p_retailprice").alias("m")).collect()}
    runs.log_run(spark, path, "brand_mean", {"column": "p_retailprice"}, metrics)
    return runs.read_runs(spark, path).select("run_name", F.explode("metrics").alias("part", "v")).select(
        "run_name", "part", F.round("v", 4).alias("value"))
