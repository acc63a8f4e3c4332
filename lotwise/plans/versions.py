"""Harmonising of free-typed version names: catalogue match, then density clusters."""

from pyspark.sql import DataFrame, functions as F

from lotwise import fixed_values as fx
from lotwise.functions.text import ascii_words
from lotwise.operators.density import cluster_versions
from lotwise.operators.fitted import FitStep, FittedModel
from lotwise.operators.similarity import best_matches, match_catalogue, profiles, vocabulary
from lotwise.session import join_lookup, materialize, materialize_counted


class HarmonizeVersions(FitStep):
    """Maps each (brand, model, version) of the training rows to one canonical name.

    A version takes the catalogue name of its brand and model with the highest
    2-3-gram cosine.  What keeps its own name is clustered by density.  Brands
    and models without catalogue names are only clustered.
    """

    def __init__(self, catalogue: DataFrame | None = None, threshold: float = fx.MATCH_THRESHOLD,
                 brand: str = fx.BRAND, model: str = fx.MODEL, version: str = fx.VERSION):
        super().__init__(threshold=threshold, brand=brand, model=model, version=version)
        self.catalogue = catalogue

    def _fit(self, df):
        s = self.settings
        named = df.select(F.col(f"`{s['brand']}`").alias("brand"), F.col(f"`{s['model']}`").alias("model"),
                          F.col(f"`{s['version']}`").alias("version"))
        counts = materialize(named.where("version is not null").groupBy("brand", "model", "version")
                             .agg(F.count("*").alias("n")).withColumn("text", ascii_words(F.col("version"))), "versions", wide=True)
        codes = materialize(vocabulary(counts.select("text")), "grams")
        counts = counts.where("brand is not null and model is not null")
        mapping = harmonize(counts, self.catalogue, codes, s["threshold"])
        mapping = materialize(mapping, "mapping", wide=True)
        names = (mapping.select("brand", "model", F.col("canon").alias("name")).distinct()
                 .withColumn("text", ascii_words(F.col("name"))))
        return HarmonizeVersionsModel(s, {"mapping": mapping, "names": names, "grams": codes})


def harmonize(counts: DataFrame, catalogue: DataFrame | None, codes: DataFrame, threshold: float) -> DataFrame:
    """(brand, model, version, canon) for distinct versions with their row counts."""
    keys = ["brand", "model"]
    if catalogue is None:
        return cluster_versions(counts, keys, "version", codes).select(*keys, "version", "canon")
    quantity = "quantity" if "quantity" in catalogue.columns else None
    listed = catalogue.select(*keys, F.col("version").alias("name"), *([quantity] if quantity else []))
    listed = materialize(listed.where("name is not null"), "catalogue", wide=True)
    matched = match_catalogue(counts, listed, keys, "version", threshold, codes, quantity)
    known = listed.select(*keys).distinct().withColumn("has_catalogue", F.lit(True))
    both = materialize(join_lookup(matched.join(counts.select(*keys, "version", "n"), keys + ["version"]), known, keys)
                       .withColumn("canon", F.coalesce("name", "version"))
                       .withColumn("own", F.col("canon") == F.col("version")), "matched", wide=True)
    # in a group with catalogue names a single unmatched row is left as it is
    lone = (both.where("own and has_catalogue").groupBy(*keys).agg(F.sum("n").alias("rows"))
            .where("rows <= 1").select(*keys).withColumn("lone", F.lit(True)))
    marked = both.join(lone, keys, "left")
    settled = marked.where("not own or (has_catalogue and lone is not null)")
    open_ = marked.where("own and not coalesce(has_catalogue and lone is not null, false)")
    clustered = cluster_versions(open_.select(*keys, "version", "text", "n"), keys, "version", codes)
    return (settled.select(*keys, "version", "canon")
            .unionByName(clustered.select(*keys, "version", "canon")))


class HarmonizeVersionsModel(FittedModel):
    def apply(self, df):
        s = self.settings
        cols = {s["brand"]: "brand", s["model"]: "model", s["version"]: "version"}
        known = self.tables["mapping"].withColumnsRenamed({v: k for k, v in cols.items()})
        first = join_lookup(df, known, list(cols), self.rows["mapping"])
        # versions never seen in fit: closest canonical name of the brand and model
        unseen = (first.where(F.col("canon").isNull() & F.col(f"`{s['version']}`").isNotNull())
                  .select(*[F.col(f"`{k}`").alias(v) for k, v in cols.items()]).distinct())
        unseen, rows = materialize_counted(unseen.where("brand is not null and model is not null"), "unseen", wide=True)
        if rows == 0:
            return first.withColumn(s["version"], F.coalesce("canon", F.col(f"`{s['version']}`"))).drop("canon")
        closest = closest_names(unseen, self.tables["names"], self.tables["grams"], s["threshold"])
        closest = materialize(closest, "closest", wide=True)
        closest = closest.withColumnsRenamed({v: k for k, v in cols.items()})
        return (join_lookup(first, closest, list(cols))
                .withColumn(s["version"], F.coalesce("canon", "closest", F.col(f"`{s['version']}`")))
                .drop("canon", "closest"))

    def mapping(self) -> DataFrame:
        """Export form: Marca, Modelo, Version, version_canon."""
        return self.tables["mapping"].select(
            F.col("brand").alias("Marca"), F.col("model").alias("Modelo"),
            F.col("version").alias("Version"), F.col("canon").alias("version_canon"))


def closest_names(unseen: DataFrame, names: DataFrame, codes: DataFrame, threshold: float) -> DataFrame:
    """(brand, model, version, closest) for versions that reach the threshold."""
    keys = ["brand", "model"]
    left = unseen.withColumn("text", ascii_words(F.col("version")))
    known = materialize(profiles(left.select("text").unionByName(names.select("text")), codes), "profiles", wide=True)
    found = best_matches(left.select(*keys, "text").distinct().join(known, "text"),
                         names.join(known, "text"), keys, threshold)
    return left.join(found, keys + ["text"]).select(*keys, "version", F.col("name").alias("closest"))
