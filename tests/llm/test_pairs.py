"""Operators on pairs against all pairs of small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import groups, hamming, ngram_join, vectors
from cases import ODD, frame


def near_texts(seed=4):
    draw = random.Random(seed)
    rows, n = [], 1000
    for _ in range(30):
        words = [f"w{draw.randint(0, 5000)}" for _ in range(draw.randint(30, 200))]
        for k in range(draw.randint(1, 6)):
            copy = list(words)
            for _ in range(k % 4):
                copy[draw.randrange(len(copy))] = f"edit{draw.randint(0, 999)}"
            rows.append((n, (" " if k % 2 else "\n").join(copy), "a"))
            n += 1
    shared = " ".join(f"p{i}" for i in range(12))
    rows += [(n + i, shared + " " + " ".join(f"q{draw.randint(0, 9999)}" for _ in range(40)), "b") for i in range(150)]
    return rows


def all_pairs(rows):
    """(id, text) -> (links, least id of the component), by comparing everything."""
    shingler = ngram_join.Shingler()
    sets = [set(shingler(t or "").tolist()) for _, t, _ in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9:
                links[x] += 1
                links[y] += 1
                root[top(x)] = top(y)
    least = {}
    for x, (i, _, _) in enumerate(rows):
        if i is not None:
            least[top(x)] = min(least.get(top(x), i), i)
    return [(links[x], least.get(top(x)) if sets[x] else rows[x][0]) for x in range(len(rows))]


@pytest.mark.parametrize("bucket", [64, 4])
def test_jaccard_join(spark, monkeypatch, bucket):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)       # a small one forces the deeper levels and the block pairs
    monkeypatch.setattr(ngram_join, "BLOCK", max(bucket, 16))
    monkeypatch.setattr(ngram_join, "SKETCH_BLOCK", max(bucket, 16))
    rows = near_texts() + ODD
    out = ngram_join.jaccard_join(frame(spark, rows)).collect()
    got = sorted((r["row"]["doc_id"] or -1, r["n_links"], r["component_id"] or -1) for r in out)
    want = sorted((i or -1, n, c or -1) for (i, _, _), (n, c) in zip(rows, all_pairs(rows), strict=True))
    assert got == want
    for r in out:
        assert r["kept"] or r["component_id"] != r["row"]["doc_id"]


def test_one_per_group(spark):
    rows = near_texts() + ODD
    truth = all_pairs(rows)
    out = ngram_join.one_per_group(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in out.collect())
    want = {(i or -1, t or "") for (i, t, _), (_, c) in zip(rows, truth, strict=True) if i == c or not (t or "").split()}
    assert got == sorted(want)
    assert ngram_join.one_per_group(frame(spark, [])).count() == 0


def test_runs_and_paths():
    assert ngram_join.runs_for(0.995, 3) == math.ceil(math.log(0.005) / math.log(1 - 0.3741))
    shingles = np.unique(np.random.default_rng(0).integers(0, 2**63, 600).astype(np.uint64))
    first = ngram_join.chosen_paths(shingles, 12, 3, 0.8)
    assert [len(p) for p, _ in first] == [len(q) for _, q in first]
    part = ngram_join.chosen_paths(shingles[:590], 12, 3, 0.8)
    assert len(set(first[0][1]) & set(part[0][1])) >= 0.8 * len(first[0][1])    # a set that shares tokens shares paths
    assert len(ngram_join.chosen_paths(shingles[:1], 12, 3, 0.8)[0][1]) == 12


def test_overlap_matrix():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, k)).astype(np.uint64) for k in (0, 1, 50, 80, 200)]
    got = ngram_join.overlap_matrix(sets, width=64)
    assert (got == [[len(set(a) & set(b)) for b in map(list, sets)] for a in map(list, sets)]).all()


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(90)]
    got = {r["id"]: r["root"] for r in groups.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    ids = sorted({x for a, b in edges for x in (a, b) if a != b})
    place = {x: i for i, x in enumerate(ids)}
    real = [(place[a], place[b]) for a, b in edges if a != b]
    root = groups.roots_of_pairs(len(ids), np.array([a for a, _ in real]), np.array([b for _, b in real]))
    assert got == {x: ids[root[i]] for i, x in enumerate(ids)}
    assert groups.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_cosine_links(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 48))
    rows = [(i, (base[i % 60] + draw.normal(size=48) * 0.25 * (i // 60)).tolist()) for i in range(300)]
    rows += [(400 + i, base[0].tolist()) for i in range(20)]
    rows += [(500, None), (501, []), (502, [0.0] * 48), (503, [float("nan")] + [1.0] * 47), (504, [None] + [1.0] * 47),
             (505, [float("inf")] + [1.0] * 47), (506, [1.0] * 3), (507, [2.0] * 3), (508, [1e308] * 48), (509, [1e-300] * 48),
             (510, [1.0]), (511, [2.0]), (None, [1.0] * 48), (508, [1e308] * 48)]
    out = vectors.cosine_links(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
                               .withColumn("key", F.lit("clash")).withColumn("size", F.lit(1))).collect()
    good = [(k, np.array(v) / np.linalg.norm(np.array(v) / np.abs(v).max()) / np.abs(v).max()) for k, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, left, right = [0] * len(rows), [], []
    for a, x in good:
        for b, y in good:
            if a < b and len(x) == len(y) and x @ y >= 0.9:
                links[a] += 1
                links[b] += 1
                left.append(a)
                right.append(b)
    root = groups.roots_of_pairs(len(rows), np.array(left), np.array(right))
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=-1) for r in set(root.tolist())}
    want = sorted((rows[k][0] or -1, links[k], least[root[k]]) for k in range(len(rows)))
    got = sorted((r["row"]["vec_id"] or -1, r["n_links"], -1 if r["component_id"] is None else r["component_id"]) for r in out)
    assert sum(g != w for g, w in zip(got, want, strict=True)) == 0
    assert vectors.cosine_links(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_bucket_recall():
    """Pairs at the limit meet in some bucket nearly always."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = draw.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * noise
    a, b = vectors.buckets(x), vectors.buckets(y)
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist())]) >= 0.95


def words_of(df):
    return df.withColumn("code", F.when(F.col("code").isNotNull(), F.array("code")))


def test_top_k_of_all_components(spark):
    """Vectors of 130 components, over two words; some of another length, which are no neighbours."""
    draw = np.random.default_rng(11)
    near = draw.normal(size=(20, 130))
    vectors_ = np.concatenate([near[draw.integers(0, 20, 300)] + draw.normal(size=(300, 130)) * 0.4, draw.normal(size=(100, 130))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors_)] + [(1000 + i, v[:70].tolist()) for i, v in enumerate(vectors_[:30])]
    coded = spark.createDataFrame(rows, "id bigint, v array<double>").select("id", hamming.sign_code(F.col("v")).alias("code"))
    out = hamming.top_k(coded, coded.where("id % 20 = 0"), 7, block_codes=60, pack_queries=5).collect()
    signs = {i: np.array(v) >= 0 for i, v in rows}
    for q in (i for i in signs if i % 20 == 0):
        want = sorted((int((signs[q] != s).sum()), i) for i, s in signs.items() if i != q and len(s) == len(signs[q]))[:7]
        assert [(r["distance"], r["neighbour_id"]) for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == want


def test_top_k(spark):
    draw = np.random.default_rng(6)
    codes = draw.integers(-2**63, 2**63 - 1, 500)
    codes[100:160] = codes[100]                 # more equal codes than k
    codes[200:260] = codes[200] ^ (1 << draw.integers(0, 63, 60))
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(7, int(codes[7])), (600, None), (None, 5)]
    frame_ = words_of(spark.createDataFrame(rows, "id bigint, code bigint")).withColumn("rank", F.lit(0))
    asked = frame_.where("id % 20 = 0 or id is null or code is null")
    for block, pack in ((10_000, 10_000), (90, 7)):
        out = hamming.top_k(frame_, asked, 10, block_codes=block, pack_queries=pack).collect()
        for q in range(0, 500, 20):
            want = sorted((bin((int(codes[q]) ^ int(c)) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes) if i != q)[:10]
            assert [(r["distance"], r["neighbour_id"]) for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == want
        assert {r["query_id"] for r in out} == set(range(0, 500, 20))
    few = words_of(spark.createDataFrame([(1, 1), (2, 3)], "id bigint, code bigint"))
    assert hamming.top_k(few, few, 10).count() == 2 and hamming.top_k(few.limit(0), few, 3).count() == 0


def test_sign_code(spark):
    rows = [(1, [1.0, -1.0, 0.0]), (2, None), (3, []), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [1.0] * 64), (7, [-1.0] * 63 + [1.0, 5.0])]
    got = {r["id"]: r["code"] for r in spark.createDataFrame(rows, "id int, v array<double>").select("id", hamming.sign_code(F.col("v")).alias("code")).collect()}
    assert got == {1: [(0b101 << 61) - 2**64], 2: None, 3: None, 4: None, 5: None, 6: [-1], 7: [1, -2**63]}


def test_components_with_a_hub(spark):
    from lotwise.llm import groups
    star = [(0, i) for i in range(1, 10_000)] + [(20_000 + i, 20_001 + i) for i in range(50)]
    edges = spark.createDataFrame(star, "a bigint, b bigint").repartition(8)
    root = {r["id"]: r["root"] for r in groups.components(edges).collect()}
    assert len(root) == 10_051 and {root[i] for i in range(10_000)} == {0} and {root[i] for i in range(20_000, 20_051)} == {20_000}
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    dealt = groups.join_split(ends, ends.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows")), ["a"], "b")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2 * len(star) and max(sizes) < 3 * sum(sizes) / 4
