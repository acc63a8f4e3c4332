from pathlib import Path
from urllib.parse import urlparse

from checks import numeric, profile, sources
from lotwise.sources import cars, files


def test_records_lie_in_few_files(spark, tmp_path):
    rows = [(i, f"part {i}", "B" if i % 4 else None, "T", 9 if i % 5 == 0 else i % 8, float(i)) for i in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    path = sources.record_files(spark, str(tmp_path))
    assert len(list(Path(urlparse(path).path).rglob("*.json"))) <= 20
    assert len(cars.read_records(spark, path, one_per_file=False).collect()) == 240
    assert sorted(int(r["version"]) for r in sources.broken_records(spark, str(tmp_path)).collect()) == list(range(0, 300, 5))
    assert sources.car_records(spark, str(tmp_path)).count() == sum(r[4] != 9 and r[4] % 2 == 0 for r in rows)


def test_csv_files_hold_a_bounded_number_of_rows(spark, tmp_path):
    rows = [(i, f'line {i}\nand "more"') for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, note string")
    files.write_csv(df.coalesce(1), str(tmp_path / "csv"), rows=100)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 10
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "csv"), df.schema).collect())) == rows


def test_listings_alike_are_cleaned_once(spark, tmp_path):
    items = [(1, i % 2, 0, 1, 1.0, 100.0, "A" if i % 4 else "N", "O") for i in range(200)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(0, "blue ring", "B", "T"), (1, "old bolt", None, "T")], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    found = profile.version_counts(spark, str(tmp_path))
    assert found.count() == 3 and found.agg({"n": "sum"}).first()[0] == 200
    want = profile.cleaned(spark, str(tmp_path)).where("version is not null").groupBy("marca", "version").count().collect()
    assert sorted(map(repr, found.groupBy("marca", "version").sum("n").collect())) == sorted(repr(r).replace("count=", "sum(n)=") for r in want)


def test_candidates_are_ranked_without_written_pairs(spark):
    requests = [("a", "m", "t", "blue ring", "2015", None), ("b", "m", "t", "Ring", None, None), ("b", "m", "t", "Ring", None, None),
                ("c", "m", "t", None, None, "gas"), ("d", "m", "x", "bolt", None, ""), ("e", "m", "t", "!", "2016", "gas"), (None, "m", "t", "ring", None, None)]
    records = [(i, "m", "t", ["blue ring", "ring", "red bolt", None, ""][i % 5], str(2015 + i % 2), "gas" if i % 3 else None) for i in range(40)] + [(99, None, "t", "ring", "2015", "gas")]
    rest = "bodystyle string, transmission string, displacement string, power string"
    asked, listed = (spark.createDataFrame([(*r, None, None, None, None) for r in rows], f"{key}, make string, model string, trim string, year string, fuel string, {rest}")
                     for rows, key in ((requests, "request_id string"), (records, "record_id int")))

    def cosine(a, b):
        a, b = ({g: t.count(g) and sum(t[i:i + len(g)] == g for i in range(len(t))) for n in (2, 3) for g in {t[i:i + n] for i in range(len(t) - n + 1)}}
                for t in ((x or "").lower().strip("!") for x in (a, b)))
        size = sum(v * v for v in a.values()) * sum(v * v for v in b.values())
        return sum(v * b.get(g, 0) for g, v in a.items()) / size ** 0.5 if size else 0.0

    want = {}
    for key, make, model, trim, year, fuel in requests:
        for i, m, t, other, y, f in records:
            if key is not None and (m, t) == (make, model) and (not year or y == year) and (not fuel or f == fuel):
                want.setdefault(key, []).append((i, round(cosine(trim, other), 9)))
    found = cars.find_versions(asked, listed)
    got = {}
    for r in found.collect():
        got.setdefault(r["request_id"], []).append((r["record_id"], round(r["score"], 9)))
        assert r["candidates"] == len(want[r["request_id"]]) and r["is_match"] == (r["candidates"] == 1)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r["record_id"] for r in found.where("request_id = 'a'").orderBy("place").collect()]
    assert order == [i for i, _ in sorted(want["a"], key=lambda x: (-x[1], x[0]))]
    narrow, pairs = found.select("request_id", "record_id", "is_match"), sum(map(len, want.values()))
    assert all(spark.read.parquet(x).count() < pairs for x in {f.rsplit("/", 1)[0] for f in narrow.inputFiles()})
    assert "Window" not in narrow._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_versions_are_counted_by_model_before_cleaning(spark, tmp_path):
    items = [(1, i % 3, 0, 1 + i % 4, 1.0, 100.0, "A" if i % 4 else "N", "O") for i in range(400)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(0, "blue ring", "B", "T"), (1, "old bolt", None, "T"), (2, "red nut", "B", None)], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    found = profile.version_counts(spark, str(tmp_path))
    want = profile.cleaned(spark, str(tmp_path)).where("version is not null").groupBy("marca", "modelo", "version").count().collect()
    got = found.groupBy("marca", "modelo", "version").sum("n").collect()
    assert sorted(map(repr, got)) == sorted(repr(r).replace("count=", "sum(n)=") for r in want)
    plan = numeric.linkage_clusters(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "lineitem" not in plan
