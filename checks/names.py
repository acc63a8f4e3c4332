"""Similarity joins, density clusters and version harmonising over the listing and catalogue views."""

from pyspark.sql import functions as F

from checks import query
from checks.fixture import L, LC, catalogue, listings, table
from lotwise.functions.text import ascii_words
from lotwise.operators import density, similarity as sim
from lotwise.plans.versions import HarmonizeVersions, closest_names
from lotwise.operators.encoders import hash_split
from lotwise.session import materialize

c = F.col


def _words(x):
    return f"trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9 ]+', ' ', 'g'))"


def _vectors(name, source):
    """Gram counts of the distinct texts of ``source`` as SQL (squeezed white space, grams known to ``vocab``)."""
    return f"""{name}_g AS (SELECT text, sq, unnest(list_concat(
      list_transform(range(1, greatest(length(sq), 1)), lambda i: substring(sq, i, 2)), list_transform(range(1, greatest(length(sq) - 1, 1)), lambda i: substring(sq, i, 3)))) AS gram
    FROM (SELECT DISTINCT text, regexp_replace(text, '\\s+', ' ', 'g') AS sq FROM {source}) t),
  {name} AS MATERIALIZED (SELECT text, gram, count(*) AS tf FROM {name}_g GROUP BY ALL),
  {name}_n AS MATERIALIZED (SELECT text, sum(tf * tf) AS nsq FROM {name} GROUP BY text)"""


def versions_of(spark, sf):
    df = listings(spark, sf).where("version is not null")
    out = df.groupBy(c("marca").alias("brand"), c("modelo").alias("model"), "version").agg(F.count("*").alias("n"))
    return materialize(out.withColumn("text", ascii_words(c("version"))), "versions", wide=True)


_VERSIONS = f"versions AS MATERIALIZED (SELECT marca AS brand, modelo AS model, version, count(*) AS n, {_words('version')} AS text FROM listings WHERE version IS NOT NULL GROUP BY ALL)"
_VOCAB = _vectors("v", "versions") + ", vocab AS (SELECT DISTINCT gram FROM v)"
_CAT = f"""names AS (SELECT brand, model, version AS name, {_words('version')} AS text FROM catalogue WHERE version IS NOT NULL),
  {_vectors('k0', 'names')}, k AS (SELECT * FROM k0 WHERE gram IN (SELECT gram FROM vocab)), k_n AS (SELECT text, sum(tf * tf) AS nsq FROM k GROUP BY text)"""
_BEST = """sg AS (SELECT s.brand, s.model, s.version, s.text, v.gram, v.tf FROM versions s JOIN v USING (text)), kg AS (SELECT m.brand, m.model, m.name, m.text, k.gram, k.tf FROM names m JOIN k USING (text)),
  dot0 AS (SELECT brand, model, sg.version, sg.text AS t1, kg.name, kg.text AS t2, sum(sg.tf * kg.tf) AS dot FROM sg JOIN kg USING (brand, model, gram) GROUP BY ALL),
  scored AS (SELECT brand, model, version, name, dot::DOUBLE / sqrt((a.nsq * b.nsq)::DOUBLE) AS score FROM dot0 JOIN v_n a ON a.text = t1 JOIN k_n b ON b.text = t2),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand, model, version ORDER BY score DESC, name) AS rn FROM scored) t WHERE rn = 1 AND score >= 0.2)"""


@query("catalogue_match_c2", f"""{LC}, {_VERSIONS}, {_VOCAB}, {_CAT}, {_BEST}
  SELECT s.brand, s.model, s.version, b.name, round(b.score, 6) AS score FROM versions s LEFT JOIN best b USING (brand, model, version)""")
def catalogue_match(spark, sf):
    versions = versions_of(spark, sf)
    codes = materialize(sim.vocabulary(versions.select("text")), "grams")
    names = catalogue(spark, sf).withColumnRenamed("version", "name")
    out = sim.match_catalogue(versions, names, ["brand", "model"], "version", 0.2, codes)
    return out.select("brand", "model", "version", "name", F.round("score", 6).alias("score"))


@query("mapping_lookup_c1", f"""{LC}, {_VERSIONS}, {_VOCAB}, {_CAT}, {_BEST}
  SELECT l.idx, coalesce(b.name, l.version) AS version FROM listings l LEFT JOIN best b ON l.marca = b.brand AND l.modelo = b.model AND l.version = b.version""")
def mapping_lookup(spark, sf):
    from lotwise.session import join_lookup
    found = catalogue_match(spark, sf).where("name is not null")
    mapping = materialize(found.select(c("brand").alias("marca"), c("model").alias("modelo"), "version", "name"), "mapping", wide=True)
    out = join_lookup(listings(spark, sf), mapping, ["marca", "modelo", "version"])
    return out.select("idx", F.coalesce("name", "version").alias("version"))


_DBSCAN = """grp AS (SELECT brand, model, greatest(2, sum(n)::BIGINT // 10) AS least FROM versions WHERE text <> '' GROUP BY ALL),
  pts AS (SELECT brand, model, text, sum(n)::BIGINT AS w FROM versions WHERE text <> '' GROUP BY ALL),
  pg AS MATERIALIZED (SELECT p.brand, p.model, p.text, v.gram, v.tf FROM pts p JOIN v USING (text)),
  dots AS MATERIALIZED (SELECT a.brand, a.model, a.text AS x, b.text AS y, sum(a.tf * b.tf) AS dot FROM pg a JOIN pg b USING (brand, model, gram) GROUP BY ALL),
  near AS MATERIALIZED (SELECT d.brand, d.model, d.x, d.y, p.w, dot::DOUBLE / sqrt((xn.nsq * yn.nsq)::DOUBLE) AS score FROM dots d JOIN v_n xn ON xn.text = d.x JOIN v_n yn ON yn.text = d.y
    JOIN pts p ON p.brand = d.brand AND p.model = d.model AND p.text = d.y WHERE dot::DOUBLE / sqrt((xn.nsq * yn.nsq)::DOUBLE) >= 0.7),
  core AS (SELECT brand, model, x AS text FROM near JOIN grp USING (brand, model) GROUP BY brand, model, x HAVING sum(w) >= max(least)),
  edges AS (SELECT n.brand, n.model, n.x, n.y FROM near n JOIN core a ON a.brand = n.brand AND a.model = n.model AND a.text = n.x JOIN core b ON b.brand = n.brand AND b.model = n.model AND b.text = n.y),
  reach AS (SELECT brand, model, x, y FROM edges UNION SELECT r.brand, r.model, r.x, e.y FROM reach r JOIN edges e ON e.brand = r.brand AND e.model = r.model AND e.x = r.y),
  comp AS (SELECT brand, model, x AS text, min(y) AS cluster FROM reach GROUP BY ALL),
  touch AS (SELECT n.brand, n.model, n.x AS text, min(cluster) AS cluster FROM near n JOIN comp k ON k.brand = n.brand AND k.model = n.model AND k.text = n.y
    WHERE NOT EXISTS (SELECT 1 FROM comp z WHERE z.brand = n.brand AND z.model = n.model AND z.text = n.x) GROUP BY ALL),
  placed AS (SELECT * FROM comp UNION ALL SELECT * FROM touch),
  member AS (SELECT s.brand, s.model, s.version, s.n, p.cluster FROM versions s LEFT JOIN placed p USING (brand, model, text) WHERE s.text <> ''),
  lab AS (SELECT * FROM (SELECT brand, model, cluster, version, row_number() OVER (PARTITION BY brand, model, cluster ORDER BY sum(n) DESC, version) AS rn FROM member WHERE cluster IS NOT NULL GROUP BY brand, model, cluster, version) t WHERE rn = 1)"""


@query("density_clusters_i2", f"""WITH RECURSIVE {L[5:]}, {_VERSIONS}, {_VOCAB}, {_DBSCAN}
  SELECT m.brand, m.model, m.version, m.cluster, coalesce(l.version, m.version) AS canon FROM member m LEFT JOIN lab l ON l.brand = m.brand AND l.model = m.model AND l.cluster = m.cluster""")
def density_clusters(spark, sf):
    versions = versions_of(spark, sf)
    codes = materialize(sim.vocabulary(versions.select("text")), "grams")
    return density.cluster_versions(versions, ["brand", "model"], "version", codes).select(
        "brand", "model", "version", "cluster", "canon")


# harmonising: catalogue match, then density clusters over what kept its own name
_REST = """matched AS (SELECT s.*, b.name, coalesce(b.name, s.version) AS canon FROM versions0 s LEFT JOIN best b USING (brand, model, version)),
  hascat AS (SELECT DISTINCT brand, model FROM names), own AS (SELECT m.*, h.brand IS NOT NULL AS has FROM matched m LEFT JOIN hascat h ON h.brand = m.brand AND h.model = m.model WHERE m.canon = m.version),
  lone AS (SELECT brand, model FROM own WHERE has GROUP BY ALL HAVING sum(n) <= 1),
  versions AS (SELECT brand, model, version, n, text FROM own o WHERE NOT (has AND EXISTS (SELECT 1 FROM lone x WHERE x.brand = o.brand AND x.model = o.model)))"""
_MAPPING = f"""WITH RECURSIVE {LC[5:]}, {_VERSIONS.replace('versions AS', 'versions0 AS').replace('FROM listings WHERE', 'FROM SRC WHERE')},
  {_VOCAB.replace('FROM versions)', 'FROM versions0)')}, {_CAT}, {_BEST.replace('FROM versions s', 'FROM versions0 s')}, {_REST}, {_DBSCAN},
  mapping AS MATERIALIZED (SELECT brand, model, version, canon FROM matched m WHERE canon <> version OR (EXISTS (SELECT 1 FROM lone x WHERE x.brand = m.brand AND x.model = m.model) AND EXISTS (SELECT 1 FROM hascat h WHERE h.brand = m.brand AND h.model = m.model))
    UNION ALL SELECT m.brand, m.model, m.version, coalesce(l.version, m.version) FROM member m LEFT JOIN lab l ON l.brand = m.brand AND l.model = m.model AND l.cluster = m.cluster)"""


@query("version_mapping_i3", f"""{_MAPPING.replace('FROM SRC', 'FROM listings')}
  SELECT brand AS "Marca", model AS "Modelo", version AS "Version", canon AS version_canon FROM mapping""")
def version_mapping(spark, sf):
    step = HarmonizeVersions(catalogue(spark, sf), brand="marca", model="modelo", version="version")
    return step.fit(listings(spark, sf)).mapping()


_HASHED = "cast('0x' || substr(md5(concat(idx, '|42')), 1, 8) as bigint) % 100 >= 20"
_SEEN = """names2 AS MATERIALIZED (SELECT DISTINCT brand, model, canon AS name, W AS text FROM mapping),
  unseen AS MATERIALIZED (SELECT DISTINCT l.marca AS brand, l.modelo AS model, l.version, U AS text FROM listings l WHERE l.version IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM mapping m WHERE m.brand = l.marca AND m.model = l.modelo AND m.version = l.version))""".replace(
    "W AS", _words("canon") + " AS").replace("U AS", _words("l.version") + " AS")
_CLOSEST = f"""{_SEEN}, {_vectors('a0', 'unseen')}, a AS (SELECT * FROM a0 WHERE gram IN (SELECT gram FROM vocab)), a_n AS (SELECT text, sum(tf * tf) AS nsq FROM a GROUP BY text),
  {_vectors('d0', 'names2')}, d AS (SELECT * FROM d0 WHERE gram IN (SELECT gram FROM vocab)), d_n AS (SELECT text, sum(tf * tf) AS nsq FROM d GROUP BY text),
  ag AS MATERIALIZED (SELECT s.brand, s.model, s.version, s.text, a.gram, a.tf FROM unseen s JOIN a USING (text)), dg AS MATERIALIZED (SELECT m.brand, m.model, m.name, m.text, d.gram, d.tf FROM names2 m JOIN d USING (text)),
  dot1 AS (SELECT brand, model, ag.version, ag.text AS t1, dg.name, dg.text AS t2, sum(ag.tf * dg.tf) AS dot FROM ag JOIN dg USING (brand, model, gram) GROUP BY ALL),
  sc AS (SELECT brand, model, version, name, dot::DOUBLE / sqrt((x.nsq * y.nsq)::DOUBLE) AS score FROM dot1 JOIN a_n x ON x.text = t1 JOIN d_n y ON y.text = t2),
  closest AS (SELECT brand, model, version, name FROM (SELECT *, row_number() OVER (PARTITION BY brand, model, version ORDER BY score DESC, name) AS rn FROM sc) t WHERE rn = 1 AND score >= 0.2)"""


@query("harmonize_versions_i1", f"""{_MAPPING.replace('FROM SRC WHERE', f'FROM listings WHERE {_HASHED} AND')}, {_CLOSEST}
  SELECT l.idx, coalesce(m.canon, k.name, l.version) AS version FROM listings l LEFT JOIN mapping m ON m.brand = l.marca AND m.model = l.modelo AND m.version = l.version
  LEFT JOIN closest k ON k.brand = l.marca AND k.model = l.modelo AND k.version = l.version""")
def harmonize_versions(spark, sf):
    df = materialize(hash_split(listings(spark, sf).select("idx", "marca", "modelo", "version"), "idx"), "rows")
    step = HarmonizeVersions(catalogue(spark, sf), brand="marca", model="modelo", version="version")
    return step.fit(df.where("split <> 'test'")).transform(df).select("idx", "version")


@query("closest_known_c3", f"""{_MAPPING.replace('FROM SRC WHERE', f'FROM listings WHERE {_HASHED} AND')}, {_CLOSEST}
  SELECT u.brand, u.model, u.version, coalesce(k.name, u.version) AS version_canon FROM unseen u LEFT JOIN closest k USING (brand, model, version)""")
def closest_known(spark, sf):
    df = materialize(hash_split(listings(spark, sf).select("idx", "marca", "modelo", "version"), "idx"), "rows")
    step = HarmonizeVersions(catalogue(spark, sf), brand="marca", model="modelo", version="version")
    model = step.fit(df.where("split <> 'test'"))
    seen = model.tables["mapping"].select("brand", "model", "version")
    every = df.where("version is not null").select(c("marca").alias("brand"), c("modelo").alias("model"), "version").distinct()
    unseen = materialize(every.join(seen, ["brand", "model", "version"], "left_anti"), "unseen", wide=True)
    close = closest_names(unseen, model.tables["names"], model.tables["grams"], 0.2)
    return (unseen.join(close, ["brand", "model", "version"], "left")
            .select("brand", "model", "version", F.coalesce("closest", "version").alias("version_canon")))
