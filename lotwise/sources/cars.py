"""Car records in JSON: scan, flatten, look-up of listings, and match answers."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lotwise import fixed_values as fx
from lotwise.functions.text import ascii_words, repair_letters
from lotwise.operators.similarity import profiles, sparse_dot, vocabulary
from lotwise.session import join_lookup, materialize, materialize_counted

TEXTS = ["Marca", "Modelo", "Version", "Carroceria", "Segmento", "Propulsion", "Transmision",
         "Potencia", "Cilindrada", "Origen", "Garantia"]
RECORD = StructType(
    [StructField(name, StringType()) for name in [*TEXTS, "VersionYear"]]
    + [StructField("Precio", StructType([StructField("Moneda", StringType()), StructField("Importe", DoubleType())])),
       StructField("_corrupt_record", StringType())])
FLAT = ["Marca", "Modelo", "Version", "VersionYear", "Carroceria", "Segmento", "Propulsion", "Transmision",
        "Potencia", "Cilindrada", "Origen", "Garantia", "Moneda", "Importe"]


def read_records(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Nested records below year folders; files that are no JSON are left out."""
    raw = (spark.read.schema(RECORD).option("multiLine", one_per_file).option("mode", "PERMISSIVE")
           .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path))
    return raw.where("_corrupt_record is null").drop("_corrupt_record")


def bad_records(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """(file, _corrupt_record) of the files, or lines, that are no record."""
    texts = (spark.read.option("wholetext", one_per_file).option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.json").text(path).withColumn("file", F.input_file_name()))
    parsed = F.from_json("value", RECORD, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return texts.where(parsed["_corrupt_record"].isNotNull()).select("file", F.col("value").alias("_corrupt_record"))


def flatten_records(records: DataFrame, body: str = "SUV") -> DataFrame:
    """One flat row per record of one body type; a missing text is empty, a missing price struct gives nulls."""
    def text(name):
        return F.coalesce(repair_letters(F.col(name)), F.lit("")).alias(name)
    flat = records.where(F.col("Carroceria") == body)
    parts = {name: text(name) for name in TEXTS}
    parts["VersionYear"] = F.coalesce("VersionYear", F.lit("")).alias("VersionYear")
    parts["Moneda"] = F.coalesce(repair_letters(F.col("Precio.Moneda")), F.lit("")).alias("Moneda")
    parts["Importe"] = F.col("Precio.Importe").alias("Importe")
    return flat.select(*[parts[name] for name in FLAT])


# ------------------------------------------------------------------ look-up
OPTIONAL = ["year", "bodystyle", "transmission", "displacement", "power", "fuel"]


def find_versions(requests: DataFrame, records: DataFrame) -> DataFrame:
    """Candidate records of each request: (request_id, record_id, score, place, is_match).

    ``requests`` and ``records`` hold make, model, trim and the optional
    attributes; an attribute restricts only where the request gives it.  The
    join is an equi-join for every set of given attributes: records repeat
    once per set that occurs, with the other attributes blanked, so no pair is
    formed that a filter would drop again.  Candidates are ranked by how close
    their trim is; a request with one candidate has its match.
    """
    blank = requests.where("make is null or make = '' or model is null or model = ''")
    if not blank.isEmpty():
        raise ValueError("make and model are required")
    asked = materialize(requests.withColumn("given", _given_mask()), "asked", wide=True)
    sets = [row["given"] for row in asked.select("given").distinct().collect()]     # at most 2 ** 6 numbers
    keys = ["given", "make", "model"] + OPTIONAL
    known, texts = _trim_profiles(asked, records)
    sides = _with_profile(records, known, texts, "r").withColumn("given", F.explode(F.array(*[F.lit(m) for m in sets])))
    shared = sides.select("record_id", "r", *_masked(keys))
    left = asked.select("request_id", "trim", *_masked(keys))
    # counted by group of records, so a request knows its candidates before any pair is formed
    sizes = (left.join(shared.groupBy(*keys).agg(F.count("*").alias("records")), keys)
             .groupBy("request_id").agg(F.sum("records").alias("candidates")))
    left = _with_profile(left, known, texts, "q").join(materialize(sizes, "sizes", wide=True), "request_id")
    pairs = left.join(shared, keys)
    place = F.row_number().over(Window.partitionBy("request_id").orderBy(F.desc("score"), F.col("record_id")))
    return (pairs.select("request_id", "record_id", _trim_score("q", "r").alias("score"), "candidates")
            .withColumn("place", place).withColumn("is_match", F.col("candidates") == 1)
            .select("request_id", "record_id", "score", "place", "candidates", "is_match"))


def _given_mask():
    bits = [F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1 << i).otherwise(0)
            for i, c in enumerate(OPTIONAL)]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return total.cast("int")


def _masked(keys):
    out = []
    for key in keys:
        if key in OPTIONAL:
            used = F.col("given").bitwiseAND(1 << OPTIONAL.index(key)) != 0
            out.append(F.when(used, F.col(key).cast("string")).otherwise("").alias(key))
        else:
            out.append(F.col(key))
    return out


def _trim_profiles(requests: DataFrame, records: DataFrame) -> tuple[DataFrame, int]:
    """Gram counts of the distinct trims of both sides, and their number."""
    trims = requests.select("trim").distinct().unionByName(records.select("trim").distinct())
    texts = trims.select(ascii_words(F.col("trim")).alias("text")).where("text <> ''")
    texts = materialize(texts.distinct(), "trims", wide=True)
    return materialize_counted(profiles(texts, vocabulary(texts)), "profiles", wide=True)


def _with_profile(df: DataFrame, known: DataFrame, rows: int, name: str) -> DataFrame:
    """``df`` with the gram counts of its trim in the struct ``name``, null where it has none."""
    table = known.select("text", F.struct("codes", "tfs", "nsq").alias(name))
    return join_lookup(df.withColumn("text", ascii_words(F.col("trim"))), table, ["text"], rows).drop("text")


def _trim_score(a: str, b: str):
    """Cosine of 2-3-grams between two trims; 0 where either has none."""
    def counts(side, part):
        return F.coalesce(F.col(f"{side}.{part}"), F.array().cast("array<int>"))
    dot = sparse_dot(counts(a, "codes"), counts(a, "tfs"), counts(b, "codes"), counts(b, "tfs"))
    return F.coalesce(dot / F.sqrt(F.col(f"{a}.nsq") * F.col(f"{b}.nsq")), F.lit(0.0))


# ------------------------------------------------------------------ match answers
ANSWER = ("struct<Match: struct<Marca: string, Modelo: string, Nombre: string, Carroceria: string, Propulsion: string, "
          "Transmision: string, Potencia: string, Cilindrada: string, Segmento: string, _links: struct<href: string>>, "
          "Make: string, Model: string, Trim: string, FuelType: string, TransmisionType: string, "
          "Candidates: array<struct<Marca: string, Modelo: string, Nombre: string>>>")


def flatten_answers(df: DataFrame, answer: str = "answer") -> DataFrame:
    """The exact match as place 0, else one row per candidate from 1 on, else one row without candidate."""
    a = F.col(answer)
    def known(c):
        return F.coalesce(c, F.lit(fx.MISSING_TEXT))
    exact = a["Match"].isNotNull()
    listed = F.when(~exact, a["Candidates"])
    rows = df.select("*", F.posexplode_outer(listed).alias("pos", "candidate"))
    return rows.select(
        *[c for c in df.columns if c != answer], exact.alias("is_match"),
        F.when(exact, 0).otherwise(F.col("pos") + 1).alias("place"),
        known(F.when(exact, a["Match"]["Marca"]).otherwise(F.coalesce(F.col("candidate.Marca"), a["Make"]))).alias("brand"),
        known(F.when(exact, a["Match"]["Modelo"]).otherwise(F.coalesce(F.col("candidate.Modelo"), a["Model"]))).alias("model"),
        known(F.when(exact, a["Match"]["Nombre"]).otherwise(F.coalesce(F.col("candidate.Nombre"), a["Trim"]))).alias("version"),
        known(F.when(exact, a["Match"]["Propulsion"]).otherwise(a["FuelType"])).alias("fuel"),
        known(F.when(exact, a["Match"]["Transmision"]).otherwise(a["TransmisionType"])).alias("gearbox"),
        known(a["Match"]["Carroceria"]).alias("body"), known(a["Match"]["Potencia"]).alias("power"),
        known(a["Match"]["Cilindrada"]).alias("displacement"), known(a["Match"]["Segmento"]).alias("segment"),
        known(a["Match"]["_links"]["href"]).alias("link"))
