"""Request lines as files."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from lotwise.sources import labels


def test_requests_are_written_compressed_in_files_of_bounded_length(spark, tmp_path):
    df = spark.range(0, 5000, 1, 2).select("id", F.when(F.col("id") % 10 == 0, " ").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    settings = {"key": "id", "text": "text", "instruction": "Mark the kinds of damage the text names, as JSON."}
    labels.write_requests(df, str(tmp_path / "out"), lines=1000, **settings)
    lines = [r["value"] for r in labels.request_lines(df, **settings).collect()]
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(lines) and len(lines) == 4500
    files = [*(tmp_path / "out").glob("part-*")]
    assert sum(f.stat().st_size for f in files) * 4 < sum(len(x) + 1 for x in lines)
    assert all(len(gzip.decompress(Path(f).read_bytes()).splitlines()) <= 1000 for f in files)
