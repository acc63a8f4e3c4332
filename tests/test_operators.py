"""Operators against brute force on small data, and properties where no formula says the answer."""

import difflib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import colours, density, encoders as enc, impute, linkage, neighbours, outliers, quantiles, similarity as sim
from lotwise.operators.components import connected_components
from lotwise import session
from lotwise.session import join_lookup, materialize


def rng():
    return random.Random(7)


def words(n, seed=7):
    r = random.Random(seed)
    base = ["highline", "comfortline", "trendline", "titanium plus", "se", "freestyle", "limited edition", "s"]
    out = set()
    while len(out) < n:
        w = r.choice(base)
        if r.random() < 0.6:
            w += " " + r.choice(["at", "ii", "l20", "pack", "full", "premium", "my21"])
        if r.random() < 0.3:
            p = r.randrange(len(w))
            w = w[:p] + r.choice("abcxyz") + w[p + 1:]
        out.add(w)
    return sorted(out)


def gram_counts(text, low=2, high=3):
    out = {}
    for n in range(low, high + 1):
        for i in range(len(text) - n + 1):
            out[text[i:i + n]] = out.get(text[i:i + n], 0) + 1
    return out


def cosine(a, b):
    size = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(v * b.get(g, 0) for g, v in a.items()) / size if size else 0.0


def profiled(spark, texts):
    df = spark.createDataFrame([("k", t) for t in texts], "k string, text string")
    return df.join(sim.profiles(df, sim.vocabulary(df)), "text")


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.7, 0.92])
def test_similar_pairs_are_all_pairs(spark, threshold):
    texts = words(60)
    pairs = sim.similar_pairs(profiled(spark, texts), profiled(spark, texts), ["k"], threshold, self_join=True).collect()
    got = {(r["a"], r["b"]): r["score"] for r in pairs}
    want = {(a, b): cosine(gram_counts(a), gram_counts(b)) for a in texts for b in texts if a < b}
    want = {k: v for k, v in want.items() if v >= threshold}
    assert len(pairs) == len(got) and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_best_match_is_the_best_of_all(spark):
    texts, names = words(50), words(12, seed=3)
    left = spark.createDataFrame([("k", t) for t in texts], "k string, v string")
    right = spark.createDataFrame([("k", n, i % 3) for i, n in enumerate(names)], "k string, name string, quantity int")
    codes = sim.vocabulary(left.select(F.col("v").alias("text")))
    known = {g for t in texts for g in gram_counts(t)}
    got = {r["v"]: r["name"] for r in sim.match_catalogue(left, right, ["k"], "v", 0.2, codes, "quantity").collect()}
    for t in texts:
        scored = [(-cosine(gram_counts(t), {g: c for g, c in gram_counts(n).items() if g in known}), -(i % 3), n)
                  for i, n in enumerate(names)]
        best = min(scored)
        assert got[t] == (best[2] if -best[0] >= 0.2 and len(t) > 1 else None)


def brute_density(points, least, similarity=0.7):
    texts = sorted(points)
    near = {a: [b for b in texts if cosine(gram_counts(a), gram_counts(b)) >= similarity] for a in texts}
    core = {a for a in texts if sum(points[b] for b in near[a]) >= least}
    root = {a: a for a in core}
    changed = True
    while changed:
        changed = False
        for a in core:
            for b in near[a]:
                if b in core and root[b] < root[a]:
                    root[a], changed = root[b], True
    out = {}
    for a in texts:
        if a in core:
            out[a] = root[a]
        else:
            touched = [root[b] for b in near[a] if b in core]
            out[a] = min(touched) if touched else None
    return out


@pytest.mark.parametrize("leaders", [1, 3, 32])
def test_density_clusters(spark, leaders):
    r, texts = rng(), words(70)
    points = {t: r.randint(1, 9) for t in texts}
    for least in (2, 12, 40):
        df = profiled(spark, texts).join(spark.createDataFrame(list(points.items()), "text string, weight bigint"), "text")
        got = density.dense_clusters(df.withColumn("least", F.lit(least)), ["k"], 0.7, leaders).collect()
        want = {t: c for t, c in brute_density(points, least).items() if len(t) > 1}
        assert {x["text"]: x["cluster"] for x in got} == want


def test_folds_over_similar_pairs_are_those_of_all_pairs(spark):
    texts = words(60)
    weight = {t: i % 7 + 1 for i, t in enumerate(texts)}
    df = profiled(spark, texts).join(spark.createDataFrame(list(weight.items()), "text string, weight bigint"), "text")
    near = {a: [b for b in texts if cosine(gram_counts(a), gram_counts(b)) >= 0.5] for a in texts if len(a) > 1}
    total = {r["text"]: r["total"] for r in sim.similar_weight(df, df, ["k"], 0.5, block=16).collect()}
    assert total == {a: sum(weight[b] for b in bs) for a, bs in near.items()}
    least = {r["text"]: r["v"] for r in sim.similar_least(df, df.withColumn("v", F.reverse("text")), ["k"], 0.5, "v", block=16).collect()}
    assert least == {a: min(b[::-1] for b in bs) for a, bs in near.items()}
    node = df.withColumn("node", F.col("text"))
    links = materialize(sim.similar_links(node, node, ["k"], 0.5, block=16))
    got = {r["id"]: r["root"] for r in connected_components(df.select("k", F.col("text").alias("id")), links, ["k"]).collect()}
    want = {a: a for a in near}
    for _ in near:
        want = {a: min(want[b] for b in bs) for a, bs in near.items()}
    assert got == want


def test_density_clusters_write_no_pairs(spark, monkeypatch):
    texts = [f"1 6 blue ring {i}cv" for i in range(100, 300)]          # all alike
    written = []

    def counted(df, name="table", wide=False):
        out = materialize(df, name, wide)
        written.append((out.count(), name))
        return out

    monkeypatch.setattr(density, "materialize", counted)
    for least, cluster in ((150, texts[0]), (300, None)):
        df = profiled(spark, texts).withColumns({"weight": F.lit(1), "least": F.lit(least)})
        got = density.dense_clusters(df, ["k"], 0.7, 1).collect()
        assert {r["text"]: r["cluster"] for r in got} == {t: cluster for t in texts}
    assert max(written)[0] <= len(texts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30) if i not in (9, 19)]
    nodes = spark.createDataFrame([("k", f"{i:02d}") for i in range(33)], "k string, id string")
    e = spark.createDataFrame([("k", f"{a:02d}", f"{b:02d}") for a, b in edges], "k string, a string, b string")
    got = {int(r["id"]): int(r["root"]) for r in connected_components(nodes, e, ["k"]).collect()}
    assert all(got[i] == (0 if i < 10 else 10 if i < 20 else 20 if i < 31 else i) for i in range(33))


def brute_linkage(items, limit=0.8):
    total = sum(items.values())
    counts = {t: gram_counts(t, 3, 5) for t in items if gram_counts(t, 3, 5)}
    df = {}
    for t, c in counts.items():
        for g in c:
            df[g] = df.get(g, 0) + items[t]
    unit = {}
    for t, c in counts.items():
        v = {g: n * (math.log((1 + total) / (1 + df[g])) + 1) for g, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        unit[t] = {g: x / size for g, x in v.items()}
    clusters = [[t] for t in sorted(unit)]

    def away(a, b):
        pairs = [(items[x] * items[y], sum(v * unit[y].get(g, 0) for g, v in unit[x].items())) for x in a for y in b]
        return 1 - sum(w * s for w, s in pairs) / sum(w for w, _ in pairs)
    while len(clusters) > 1:
        d, i, j = min((round(away(a, b), 12), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        if d >= limit:
            break
        clusters[i] = sorted(clusters[i] + clusters[j])
        del clusters[j]
    return {t: c[0] for c in clusters for t in c}


def test_average_linkage(spark):
    r = rng()
    items = {t: r.randint(1, 5) for t in words(35)}
    df = spark.createDataFrame([("k", t, n) for t, n in items.items()], "k string, text string, n bigint")
    got = {x["text"]: x["cluster"] for x in linkage.linkage_clusters(df, ["k"]).collect()}
    want = brute_linkage(items)
    assert {t: c for t, c in got.items() if c is not None} == want
    assert all(len(t) < 3 for t, c in got.items() if c is None)


@pytest.mark.parametrize("pivots", [2, 16])
def test_knn_imputer(spark, pivots):
    r = rng()

    def row(i):
        return (i, *[None if r.random() < 0.3 else r.gauss(0, 1) for _ in range(3)])
    rows = [row(i) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double")
    train = [x for x in rows if x[0] < 200]
    model = neighbours.KnnImputer(["a", "b", "c"], pivots=pivots).fit(df.where("i < 200"))
    got = {x["i"]: (x["a"], x["b"], x["c"]) for x in model.transform(df).collect()}
    means = [np.mean([t[1 + f] for t in train if t[1 + f] is not None]) for f in range(3)]
    for i, *x in rows:
        for f in range(3):
            if x[f] is not None:
                assert got[i][f] == x[f]
                continue
            near = []
            for _, *d in train:
                shared = [j for j in range(3) if x[j] is not None and d[j] is not None]
                if d[f] is not None and shared:
                    near.append((sum((x[j] - d[j]) ** 2 for j in shared) * 3 / len(shared), d[f]))
            near.sort()
            want = np.mean([v for _, v in near[:5]]) if near else means[f]
            assert abs(got[i][f] - want) < 1e-9


def test_percentiles_narrow_to_the_exact_value(spark):
    r = rng()
    values = [float(r.choice([0, 5, r.randint(0, 100000)])) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for share in (0.001, 0.1, 0.25, 0.5, 0.9, 0.995, 1.0):
        got = quantiles.exact_percentiles(df, ["v"], [share], handful=5, accuracy=50)["v"][0]
        assert got == pytest.approx(np.percentile(values, share * 100), abs=1e-9)


def test_isolation_forest(spark):
    r = rng()
    rows = [(i, None if i % 50 == 0 else r.gauss(100, 10)) for i in range(3000)] + [(9001, 1e6), (9002, -1e6)]
    df = spark.createDataFrame(rows, "idx bigint, x double")
    model = outliers.IsolationForest(["x"], contamination=0.01).fit(df)
    kept = {x["idx"] for x in model.transform(df).collect()}
    removed = len(rows) - len(kept)
    assert 9001 not in kept and 9002 not in kept and all(i in kept for i in range(0, 3000, 50))
    assert 0.003 * len(rows) < removed <= 0.011 * len(rows)
    scored = df.where("x is not null").withColumn("s", model.score_udf()(F.array("x")))
    low = {x["idx"] for x in scored.where(F.col("s") < model.settings["cut"]).collect()}
    assert low == {i for i, _ in rows} - kept


def test_greedy_colours(spark):
    r = rng()
    base = ["blanco", "negro", "gris plata", "azul", "rojo", "verde oscuro"]
    values = {}
    while len(values) < 60:
        w = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice("abcdeorz")
        values["".join(w)] = r.randint(1, 9)
    df = spark.createDataFrame([(t, n, 1) for t, n in values.items()], "text string, n bigint, spelled bigint")
    got = {x["text"]: x["leader"] for x in colours.group_spellings(df).collect()}
    leaders, want = [], {}
    for t in sorted(values, key=lambda t: (-values[t], t)):
        best = difflib.get_close_matches(t, leaders, n=1, cutoff=0.8)
        want[t] = best[0] if best else t
        if not best:
            leaders.append(t)
    assert got == want


def test_base_colours(spark):
    df = spark.createDataFrame([("Blanca",), ("MARRÓN ",), ("zzz",), (None,)], "c string")
    assert {r["c"]: r["b"] for r in colours.to_base_colour(df, "c", "b").collect()} == {
        "Blanca": "blanco", "MARRÓN ": "marron", "zzz": "otro", None: "otro"}


def test_lookup_is_the_same_with_salt(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    plain = {tuple(r) for r in join_lookup(df, table, ["k"]).collect()}
    salted = {tuple(r) for r in join_lookup(df, table, ["k"], broadcast_rows=0).collect()}
    assert plain == salted and len(plain) == 300


def test_fill_levels_and_ties(spark):
    rows = [("f", "k", "se", "2", 1.0), ("f", "k", "se", "1", None), ("f", "k", "se", None, None), ("f", "k", "x", None, None),
            ("f", "z", None, None, 4.0), ("g", None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, t string, v double")
    out = impute.FillFromHierarchy(["t", "v"], ["a", "b", "c"]).fit(df).transform(df).collect()
    got = {(r["a"], r["b"], r["c"]): (r["t"], r["v"]) for r in out}
    assert got[("f", "k", "x")] == ("1", 1.0) and got[("f", "z", None)] == ("1", 4.0) and got[("g", None, None)] == ("1", 1.0)


def test_fitted_steps_guard_and_reload(spark, tmp_path):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 60.0), (None, 30.0)], "k string, y double")
    with pytest.raises(RuntimeError):
        enc.TargetMean(["k"], "y").transform(df)
    with pytest.raises(ValueError):
        enc.TargetMean(["k"], "missing").fit(df)
    model = enc.TargetMean(["k"], "y").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = enc.TargetMeanModel.load(str(tmp_path / "m"))
    new = spark.createDataFrame([("a",), ("new",), (None,)], "k string")
    want = [(2 * 15 + 10 * 30) / 12, 30.0, 30.0]
    assert [r["k"] for r in model.transform(new).collect()] == pytest.approx(want)
    assert sorted(r["k"] for r in again.transform(new).collect()) == pytest.approx(sorted(want))


def test_one_hot_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    model = enc.OneHot(["k", "absent"]).fit(df)
    out = model.transform(spark.createDataFrame([("a",), ("new",), (None,)], "k string"))
    assert out.columns == ["k_a", "k_b", "k_Unknown"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 0, 1), (0, 0, 0)]


def test_exact_split_takes_the_wanted_number(spark):
    df = spark.range(101)
    assert enc.exact_split(df, "id").where("is_test").count() == math.ceil(0.2 * 101)


def test_codes_of_many_categories(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("k"))
    model = enc.OrdinalCode(["k"]).fit(df)
    order = {v: i for i, v in enumerate(sorted(str(i) for i in range(5000)))}
    new = spark.createDataFrame([("17",), ("4999",), ("new",), (None,)], "k string")
    assert [r["k"] for r in model.transform(new).collect()] == [order["17"], order["4999"], -1.0, None]
    sparse = enc.OneHot(["k"], sparse=True).fit(df).transform(new).collect()
    assert [r["k_vector"].size for r in sparse] == [5001] * 4
    assert [list(r["k_vector"].indices) for r in sparse] == [[order["17"]], [order["4999"]], [5000], []]


def test_imputer_with_forty_columns(spark):
    names = [f"c{i}" for i in range(40)]
    rows = [tuple(float(k if i < 35 else 10 * k + i) for i in range(40)) for k in range(12)]
    rows.append(tuple([3.0] * 35 + [None] * 5))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    out = neighbours.KnnImputer(names, k=1).fit(df).transform(df).where("c0 = 3").collect()
    assert len(out) == 2 and all([r[f"c{i}"] for i in range(35, 40)] == [30.0 + i for i in range(35, 40)] for r in out)


def test_grouped_medians(spark):
    r = rng()
    rows = [(f"g{i % 7}", None if i % 97 == 0 else float(r.choice([5, r.randint(0, 10_000)]))) for i in range(20_000)] + [(None, 1.0), ("one", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {g: float(np.median([v for h, v in rows if h == g and v is not None])) for g in {h for h, _ in rows if h is not None}}
    got = {x["g"]: x["median"] for x in quantiles.grouped_median(df, "g", "v", accuracy=100, handful=10).collect()}
    assert got == want


def test_exact_split_with_shared_and_null_keys(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else i % 4,) for i in range(200)], "k int")
    assert enc.exact_split(df, "k", 0.35).where("is_test").count() == 70


def test_best_matches_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 7)
    r = rng()
    words = ["".join(r.choice("abcd") for _ in range(r.randint(2, 9))) for _ in range(120)]
    left = spark.createDataFrame([("k" if i % 3 else "z", w) for i, w in enumerate(words)], "k string, version string")
    right = spark.createDataFrame([("k" if i % 2 else "z", w, i % 5) for i, w in enumerate(words[::-1][:60])], "k string, name string, quantity int")
    codes = sim.vocabulary(left.select(F.col("version").alias("text")).unionByName(right.select(F.col("name").alias("text"))))
    got = {(x["k"], x["version"]): (x["name"], x["score"]) for x in sim.match_catalogue(
        left, right, ["k"], "version", 0.2, codes, "quantity").collect()}

    def counts(t):
        out = {}
        for n in (2, 3):
            for i in range(len(t) - n + 1):
                out[t[i:i + n]] = out.get(t[i:i + n], 0) + 1
        return out

    def score(a, b):
        a, b = counts(a), counts(b)
        return sum(v * b.get(g, 0) for g, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    pool = [(x["k"], x["name"], x["quantity"]) for x in right.collect()]
    for (k, version), (name, value) in got.items():
        found = sorted((-score(version, n), -q, n) for g, n, q in pool if g == k)
        assert (name, value) == ((found[0][2], pytest.approx(-found[0][0])) if -found[0][0] >= 0.2 else (None, None))


def test_written_texts_are_not_sent_through_the_driver(spark):
    table = materialize(spark.range(50).select("id", F.lit("a text").alias("text")), "texts", wide=True)
    plan = spark.range(10).join(table.groupBy("id", "text").count(), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_lookup_repeats_a_large_table_within_bounds(spark, monkeypatch):
    monkeypatch.setattr(session, "REPEATED", 6)
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"k{i % 4}") for i in range(100)], "i int, k string")
    table = spark.createDataFrame([("k0", 1), ("k1", 2), (None, 3)], "k string, v int")
    joined = join_lookup(df, table, ["k"], broadcast_rows=0)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("explode([0,1])") == 1
    assert sorted((r["i"], r["v"]) for r in joined.collect() if r["v"]) == [(i, 1 + i % 4) for i in range(100) if i % 5 and i % 4 < 2] and joined.count() == 100
