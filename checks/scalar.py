"""Text and price functions over the listing view."""

from pyspark.sql import functions as F

from checks import query
from checks import fixture as fx
from checks.fixture import CLEAN, L, listings, plain, raw, table
from lotwise import fixed_values as fixed
from lotwise.functions import price as pr, text as tx
from lotwise.plans.clean import clean_listings, fill_zero

c = F.col


@query("turbo_flag_h1", f"{L} SELECT idx, {fx.sql_turbo('motor', 'version')} AS turbo FROM listings")
def turbo(spark, sf):
    return listings(spark, sf).select("idx", tx.turbo_flag(c("motor"), c("version")).alias("turbo"))


@query("horse_power_h2", f"{L} SELECT idx, {fx.sql_cv('version', 'titulo', 'descripcion')} AS cv FROM listings")
def power(spark, sf):
    return listings(spark, sf).select("idx", tx.horse_power(c("version"), c("titulo"), c("descripcion")).alias("cv"))


@query("traction_h3", f"{L} SELECT idx, {fx.sql_traction('version')} AS traccion FROM listings")
def traction(spark, sf):
    return listings(spark, sf).select("idx", tx.traction(c("version")).alias("traccion"))


@query("engine_repair_h4", f"""{L} SELECT idx, {fx.sql_motor('motor', 'version')} AS motor,
  CASE WHEN motor IS NULL OR {fx.sql_number('motor')} IS NOT NULL THEN motor
       ELSE coalesce(nullif(regexp_extract(version, '^(\\d\\.\\d)', 1), ''), motor) END AS motor_prefix,
  try_cast(nullif(regexp_extract(motor, '\\b(\\d\\.\\d)', 1), '') AS DOUBLE) AS motor_leading FROM listings""")
def engine(spark, sf):
    return listings(spark, sf).select(
        "idx", tx.engine_repair(c("motor"), c("version")).alias("motor"),
        tx.engine_repair_prefix(c("motor"), c("version")).alias("motor_prefix"),
        tx.engine_leading(c("motor")).alias("motor_leading"))


@query("drop_engine_size_h5", f"{L} SELECT idx, {fx.sql_drop_engine('version')} AS version FROM listings")
def drop_engine(spark, sf):
    return listings(spark, sf).select("idx", tx.drop_engine_size(c("version")).alias("version"))


@query("drop_gearbox_h6", f"{L} SELECT idx, {fx.sql_drop_gearbox('version')} AS version FROM listings")
def drop_gearbox(spark, sf):
    return listings(spark, sf).select("idx", tx.drop_gearbox(c("version")).alias("version"))


@query("drop_power_h7", f"{L} SELECT idx, {fx.sql_drop_power('version')} AS version FROM listings")
def drop_power(spark, sf):
    return listings(spark, sf).select("idx", tx.drop_power(c("version")).alias("version"))


@query("drop_traction_h8", f"{L} SELECT idx, {fx.sql_drop_traction('version')} AS version FROM listings")
def drop_traction(spark, sf):
    return listings(spark, sf).select("idx", tx.drop_traction(c("version")).alias("version"))


@query("drop_row_words_h9", f"""{L},
long_text AS (SELECT *, titulo || ' ' || coalesce(combustible, 'gnc') || ' SUV ' || version AS t FROM listings)
SELECT idx, {fx.sql_drop_words('t')} AS version FROM long_text""")
def drop_words(spark, sf):
    text = F.concat(c("titulo"), F.lit(" "), F.coalesce(c("combustible"), F.lit("gnc")), F.lit(" SUV "), c("version"))
    return listings(spark, sf).select("idx", tx.drop_row_words(
        text, c("combustible"), c("marca"), c("modelo"), F.lit(None).cast("string")).alias("version"))


@query("clean_version_h10", f"{CLEAN} SELECT idx, s5 AS version FROM t5")
def clean_version(spark, sf):
    return listings(spark, sf).select("idx", tx.clean_version(
        c("version"), c("combustible"), c("marca"), c("modelo"), F.lit(None).cast("string")).alias("version"))


@query("version_from_title_h11", f"{CLEAN} SELECT idx, b5 AS version FROM t5")
def title_version(spark, sf):
    return listings(spark, sf).select("idx", tx.version_from_title(
        c("titulo"), c("combustible"), c("marca"), c("modelo"), F.lit(None).cast("string")).alias("version"))


@query("kilometres_h12", f"{L} SELECT idx, {fx.sql_km('kilometros')} AS km FROM listings")
def kilometres(spark, sf):
    return listings(spark, sf).select("idx", tx.kilometres(c("kilometros")).alias("km"))


@query("kilometres_notebook_h13", f"""{L} SELECT idx,
  {fx.sql_number("trim(replace(replace(lower(kilometros), 'km', ''), ',', ''))")} AS km,
  {fx.sql_number("replace(replace(kilometros, ' km', ''), 'km', '')")} AS km_unit FROM listings""")
def kilometres_notebook(spark, sf):
    return listings(spark, sf).select("idx", tx.kilometres_plain(c("kilometros")).alias("km"),
                                      tx.kilometres_unit_only(c("kilometros")).alias("km_unit"))


@query("down_payment_h14", f"{CLEAN} SELECT idx, anticipo FROM clean")
def down_payment(spark, sf):
    return listings(spark, sf).select("idx", tx.down_payment_flag(
        tx.kilometres(c("kilometros")), c("descripcion")).alias("anticipo"))


@query("ascii_words_h15", """SELECT doc_id,
  trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9 ]+', ' ', 'g')) AS words
FROM documents""")
def ascii_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.ascii_words(c("text")).alias("words"))


@query("fold_letters_h16", f"{L} SELECT idx, strip_accents(lower(trim(color))) AS color FROM listings")
def fold_letters(spark, sf):
    return listings(spark, sf).select("idx", tx.fold_letters(c("color")).alias("color"))


# The text seen byte by byte, as an engine without encodings says it.
_BYTES = """array_to_string(list_transform(string_split(text, ''), lambda x: CASE WHEN unicode(x) < 128 THEN x
  WHEN unicode(x) < 2048 THEN chr(192 + unicode(x) // 64) || chr(128 + unicode(x) % 64)
  WHEN unicode(x) < 65536 THEN chr(224 + unicode(x) // 4096) || chr(128 + unicode(x) // 64 % 64) || chr(128 + unicode(x) % 64)
  ELSE chr(240 + unicode(x) // 262144) || chr(128 + unicode(x) // 4096 % 64) || chr(128 + unicode(x) // 64 % 64) || chr(128 + unicode(x) % 64) END), '')"""


def _pairs_sql(text: str) -> str:
    for wrong, right in fixed.DOUBLE_ENCODED.items():
        text = f"replace({text}, '{wrong}', '{right}')"
    return text


# The SQL resolves no escapes: a text with a backslash would show as a difference; tests/test_text.py holds those.
@query("repair_letters_h17", f"SELECT doc_id, {_pairs_sql(_BYTES)} AS text, {_pairs_sql('text')} AS paired FROM documents")
def repair_letters(spark, sf):
    docs = table(spark, sf, "documents")
    # A lone quote keeps escapes from being read, so only the letter pairs are put back.
    paired = tx.repair_letters(F.concat(c("text"), F.lit('\\"')))
    return docs.select("doc_id", tx.repair_letters(c("text")).alias("text"), paired.substr(F.lit(1), F.length(paired) - 2).alias("paired"))


@query("first_integer_h18", f"{L} SELECT idx, coalesce(try_cast(nullif(regexp_extract(version, '(\\d+)', 1), '') AS BIGINT), 0) AS n FROM listings")
def first_integer(spark, sf):
    return listings(spark, sf).select("idx", tx.first_integer(c("version")).alias("n"))


@query("currency_h19", f"""{L} SELECT idx, round(CASE WHEN moneda = 'US$' THEN precio * 1400.0 ELSE precio END, 2) AS pesos,
  round(precio * CASE WHEN moneda = 'US$' THEN 1.0 WHEN moneda = '$' THEN 0.0011 ELSE 1.0 END, 4) AS usd,
  CASE WHEN moneda = 'US$' THEN 1 ELSE 0 END AS is_usd FROM listings""")
def currency(spark, sf):
    return listings(spark, sf).select(
        "idx", F.round(pr.in_local_currency(c("precio"), c("moneda")), 2).alias("pesos"),
        F.round(pr.in_dollars(c("precio"), c("moneda")), 4).alias("usd"), pr.dollar_flag(c("moneda")).alias("is_usd"))


@query("log_price_h20", f"{L} SELECT idx, round(ln(1 + precio), 8) AS log_price, round(exp(ln(1 + precio)) - 1, 2) AS back FROM listings")
def log_price(spark, sf):
    logged = pr.log_price(c("precio"))
    return listings(spark, sf).select("idx", F.round(logged, 8).alias("log_price"),
                                      F.round(pr.price_from_log(logged), 2).alias("back"))


@query("numeric_text_h21", f"""{L} SELECT idx, coalesce(regexp_matches(motor, '^\\d*\\.?\\d*$') AND regexp_matches(motor, '\\d'), false) AS is_number FROM listings""")
def numeric_text(spark, sf):
    return listings(spark, sf).select("idx", tx.is_numeric_text(c("motor")).alias("is_number"))


@query("colour_default_h22", f"{L} SELECT idx, coalesce(lower(trim(color)), 'Otro') AS color FROM listings")
def colour_default(spark, sf):
    return listings(spark, sf).select("idx", F.coalesce(tx.colour_text(c("color")), F.lit("Otro")).alias("color"))


@query("preview_h23", "SELECT doc_id, substring(text, 1, 200) AS head FROM documents")
def preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.preview(c("text")).alias("head"))


@query("new_or_used_h24", f"""{L} SELECT idx, CASE WHEN {fx.sql_km('kilometros')} <= 1000 THEN 'new'
  WHEN {fx.sql_km('kilometros')} > 1000 THEN 'used' END AS state FROM listings""")
def new_or_used(spark, sf):
    return listings(spark, sf).select("idx", pr.new_or_used(tx.kilometres(c("kilometros"))).alias("state"))


@query("clean_listings", f"""{CLEAN} SELECT idx, marca, modelo, version, motor, kilometros, precio, moneda,
  camara, turbo, cv, traccion, anticipo FROM clean""")
def stage_one(spark, sf):
    return plain(clean_listings(raw(spark, sf))).select(
        "idx", "marca", "modelo", "version", "motor", "kilometros", "precio", "moneda", "camara",
        "turbo", "cv", "traccion", "anticipo")


@query("fill_zero_b8", f"{L} SELECT idx, coalesce(camara, 0) AS camara FROM listings")
def fill(spark, sf):
    return fill_zero(listings(spark, sf), ["camara", "absent"]).select("idx", "camara")


@query("damage_words_b5", f"""{L} SELECT idx, descripcion FROM listings WHERE regexp_matches(lower(descripcion),
  'rot|a reparar|detalle|paragolpes|reparar|raya|golpe|abolladura|daño|falla|problema|averia|desperfecto|mal estado|necesita|arreglar|bollo|choc|cambiar')""")
def damage(spark, sf):
    return listings(spark, sf).where(tx.damage_words(c("descripcion"))).select("idx", "descripcion")
