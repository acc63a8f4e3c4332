"""Shares of strata against sorting."""

import hashlib
import math
from collections import Counter, defaultdict

from lotwise.operators.strata import stratified_split


def hashed(key):
    return int(hashlib.md5(f"{'' if key is None else key}|42".encode()).hexdigest()[:15], 16)


def test_every_stratum_gives_its_share(spark):
    rows = [(f"k{i}", ["a", "b", None, "d"][min(i % 7, 3)], i % 2) for i in range(1500)] + [("lone", "x", 0)]
    df = spark.createDataFrame(rows, "key string, brand string, n int").repartition(6)
    got = stratified_split(df, "key", ["brand", "n"]).collect()
    groups = defaultdict(list)
    for k, b, n in rows:
        groups[b, n].append(k)
    want = {k for keys in groups.values() for k in sorted(keys, key=hashed)[:math.ceil(0.2 * len(keys))]}
    assert {r["key"] for r in got if r["is_test"]} == want and len(got) == len(rows)


def test_repeated_and_null_keys(spark):
    rows = [(None, "a")] * 333 + [("same", "a")] * 100 + [(f"k{i}", "a") for i in range(200)] + [("same", "b")] * 10
    for share in (0.01, 0.2, 0.5, 0.97, 1.0, 0.0):
        got = stratified_split(spark.createDataFrame(rows, "key string, brand string").repartition(5), "key", ["brand"], share).collect()
        counts = Counter(r["brand"] for r in got if r["is_test"])
        assert len(got) == len(rows)
        assert (counts["a"], counts["b"]) == (math.ceil(share * 633), math.ceil(share * 10))
        taken = sorted(hashed(r["key"]) for r in got if r["is_test"] and r["brand"] == "a")
        assert taken == sorted(hashed(k) for k, b in rows if b == "a")[:len(taken)]


def test_empty(spark):
    assert stratified_split(spark.createDataFrame([], "key string, brand string"), "key", ["brand"]).count() == 0
