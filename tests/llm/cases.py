"""Rows that every operator must stand: nulls, empty and very long texts, ties, repeats, clashing columns."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, key int, `id` string, size string, tk int, _n int"
CLASH = ("r", 1, "i", "s", 2, 3)


def frame(spark, rows):
    """``rows``: (doc_id, text, source) with the other columns filled in, some under names the operators use."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *CLASH) for i, t, s in rows], SCHEMA)


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (4, "one", None), (5, "one", None), (5, "one", None),
    (None, "two words", "b"), (None, "two words", "b"), (None, None, None), (6, "x" * 50_000, "a"), (7, "word " * 20_000, "b"),
    (8, "Straße ÉCOLE \U0001F600 日本語   end", "c"),
]
