"""Manifest, packing and periodic runs against brute force, round trips and odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ODD, frame
from lotwise.llm import merkle, packing, queries_streams, runs

COLUMNS = queries_streams.COLUMNS


# ------------------------------------------------------------------ manifest
def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def text_of(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) with unique keys; the result as sorted tuples."""
    leaves = [(r, digest(*map(text_of, r))) for r in rows]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((x for x in leaves if x[0][2] == g), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for g in langs}
    trees = {g: tree_of([h for _, h in v]) for g, v in groups.items()}
    above = tree_of([trees[g][-1][0] for g in langs])
    root, out = above[-1][0], []
    for k, g in enumerate(langs):
        for place, (r, leaf) in enumerate(groups[g]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = digest(*map(text_of, (*r[:3], None if r[3] is None else r[3] + 1, r[4]))) if bad else leaf
            seen = []
            for levels, at in ((trees[g], place), (above, k)):
                for nodes in levels[:-1]:
                    other = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
                    seen.append(other)
                    now = digest(now, other) if at % 2 == 0 else digest(other, now)
                    at //= 2
            out.append((str(r[0]), str(g), leaf, trees[g][-1][0], root, digest(*seen), now, now == root))
    return sorted(out)


def manifest_of(df):
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.manifest(df, COLUMNS, {"n_chars": F.col("n_chars") + 1}, bad)
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in out.collect())


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def test_manifest_equals_plain_tree(spark):
    rnd = random.Random(3)
    ids = rnd.sample(range(-70_000, 3_000_000), 2600) + [2**62, -2**63, 2**63 - 1]
    rows = [(i, rnd.choice(["a", None, "é"]), rnd.choice(["en", "en", "en", "en", "de", None, "", "日本"]), rnd.choice([5, None]), rnd.choice(["x y", None, ""]))
            for i in ids]
    rows.append((10**9, None, "lone", 1, "one leaf in its group"))
    assert manifest_of(documents(spark, rows).repartition(5)) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    df = frame(spark, ODD)
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert manifest_of(df) == plain_manifest(rows)
    assert manifest_of(documents(spark, [])) == []
    # A third of the rows has no id and different texts, another third is one row.
    many = [(None, "s", "en", 1, f"t{i}") for i in range(150)] + [(4, "s", "en", 2, "same")] * 150 + [(i, "s", "en", 3, "") for i in range(150)]
    assert manifest_of(documents(spark, many)) == plain_manifest(many)


def test_manifest_deals_crowded_chunks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CROWD", 16)
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 2, 3]), "s", rnd.choice(["a", "b"]), 1, f"t{rnd.randrange(60)}") for _ in range(300)]
    assert manifest_of(documents(spark, rows)) == plain_manifest(rows)


def test_directory_of_many_chunks(spark):
    rnd = random.Random(5)
    chunks = sorted(rnd.sample(range(-10**6, 10**9), 4000))
    got = {r["c"]: r["before"] for r in merkle.directory(spark.createDataFrame([("=a", c, 2) for c in chunks], "g string, c bigint, rows bigint")).collect()}
    assert got == {c: 2 * k for k, c in enumerate(chunks)}


# ------------------------------------------------------------------ packing
@pytest.fixture(scope="module")
def definition():
    return queries_streams.word_tokenizer()


def plain_ids(definition, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(definition)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_packing(rows, want, size):
    """Pieces cover every document once, sequences have no gaps and fit."""
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r["row"]["doc_id"], []).append(r)
        of_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, ids in want.items():
        pieces = sorted(of_doc[doc], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == np.array(ids, dtype="<u4").tobytes()
        assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
        assert all(r["length"] > 0 and 4 * r["length"] == len(r["ids"]) and r["doc_tokens"] == len(ids) for r in pieces)
    lengths = []
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        lengths.append(at)
    assert set(of_doc) == set(want)
    return lengths


def test_packing_round_trip(spark, definition):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs.repartition(3), definition).collect()
    listed = docs.collect()
    want = dict(zip([r["doc_id"] for r in listed], plain_ids(definition, [r["text"] for r in listed]), strict=True))
    lengths = check_packing(rows, want, packing.SIZE)
    assert sum(map(packing.padding, lengths)) < 0.005 * sum(lengths)
    assert sum(lengths) / len(lengths) > 1500           # windows are long ones


def test_packing_of_odd_rows(spark, definition):
    rows = [r for r in ODD if r[0] is not None and r[0] != 5] + [(9, "a<|endoftext|>b é ΑΣ İx \x1c\x85\xa0y", "s"), (10, "No end " * 9000, "s"), (11, "word", "s")]
    df = frame(spark, rows)
    got = packing.pack(df, definition).collect()
    check_packing(got, dict(zip([r[0] for r in rows], plain_ids(definition, [r[1] for r in rows]), strict=True)), packing.SIZE)
    assert packing.pack(df.limit(0), definition).count() == 0
    twice = packing.pack(frame(spark, [(5, "one", "a"), (5, "one", "a"), (None, None, None)]), definition).collect()
    assert sorted((str(r["row"]["doc_id"]), r["length"]) for r in twice) == [("5", 2), ("5", 2), ("None", 1)]


def test_word_ids_equal_the_library(definition):
    draw, signs = random.Random(9), "aZéÀßØ×÷ªº²ñÞþÿ09'`~<|>.,!-_\"#日İΣe\u0301Ǆ\x1c\x7f\xad"
    words = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    words += ["don't", "I'LL", "x'sy", ",'s", "'ſ", "<|endoftext|>", "a<|startoftext|>b", "ÀÉÎ", "L'ÉTÉ", "K", "x" * 3000, "é" * 500]
    ids, counts = packing.WordIds(definition)(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [x[:-1] for x in plain_ids(definition, words)]


def test_cuts_cost_least():
    """The queue finds what trying all windows finds."""
    rnd, costs, size = random.Random(6), packing.Costs(3.0, 9.0, 1.0), 32
    for _ in range(200):
        places = np.array([0, *np.cumsum([rnd.randint(1, 12) for _ in range(rnd.randint(1, 30))])])
        penalty = np.array([rnd.choice([0.0, 3.0, 9.0]) for _ in places])

        def cost(a, b):
            return packing.padding(int(b - a), size) + costs.window
        best = [0.0] + [float("inf")] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = penalty[j] + min(best[i] + cost(places[i], places[j]) for i in range(j) if places[j] - places[i] <= size)
        cuts = packing.best_cuts(places, penalty, size, costs)
        fee = dict(zip(places.tolist(), penalty.tolist(), strict=True))
        assert sum(cost(a, b) + fee[int(b)] for a, b in zip(cuts, cuts[1:], strict=False)) == pytest.approx(best[-1])


# ------------------------------------------------------------------ periodic runs
def plain_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - first >= max(6, 4 * q):
                found.setdefault((first, i + q - first), q)
            i += 1
    return sorted((s, m, q) for (s, m), q in found.items())


def collapsed(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def check_runs(df):
    for r in runs.periodic_runs(df).collect():
        words = words_of(r["row"]["text"])
        want = plain_runs(words)
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == want
        assert r["collapsed"] == collapsed(words, want)


def test_runs_equal_brute_force(spark):
    rnd, rows = random.Random(7), []
    for i in range(400):
        words = [rnd.choice("abcde"[:rnd.choice([1, 2, 2, 3, 5])]) for _ in range(rnd.randint(0, 70))]
        if rnd.random() < 0.5 and len(words) > 8:
            a, p = rnd.randrange(len(words)), rnd.randint(1, 6)
            words = [w if k < a or a + (k - a) % p >= len(words) else words[a + (k - a) % p] for k, w in enumerate(words)]
        rows.append((i, rnd.choice([" ", "\t\x0b", "\n\r "]).join(words), "s"))
    check_runs(frame(spark, rows).repartition(3))


def test_runs_of_odd_rows(spark):
    check_runs(frame(spark, [r for r in ODD if r[0] != 7] + [(9, "a\x1cb\x85 \xa0 c " * 9, "s")]))
    assert runs.periodic_runs(frame(spark, ODD).limit(0)).count() == 0
    long = frame(spark, [(1, "word " * 300_000, "s"), (2, "a b c " * 100_000, "s")])
    got = {r[0]: [tuple(x) for x in r[1]] for r in runs.periodic_runs(long, keep=["doc_id"]).select("row.doc_id", "runs").collect()}
    assert got == {1: [(0, 300_000, 1)], 2: [(0, 300_000, 3)]}


def test_extensions_equal_comparison():
    rnd = np.random.default_rng(8)
    for k in (1, 2, 4):
        words = np.concatenate([[k], rnd.integers(0, k, 300), np.tile(rnd.integers(0, k, 7), 20), [k + 1]])
        whole = runs.recompress(words, 1)
        a = rnd.integers(1, len(words) - 2, 400)
        b = np.minimum(a + rnd.integers(1, 60, 400), len(words) - 1)
        a, b = a[a < b], b[a < b]
        for way, got in ((1, runs.extend(whole, a, b, True)), (-1, runs.extend(whole, a, b, False))):
            for x, y, n in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
                shift = 0 if way == 1 else -1
                m = 0
                while words[x + shift + way * m] == words[y + shift + way * m]:
                    m += 1
                assert m == n


@pytest.mark.parametrize("query", ["op13_periodic_runs"])
def test_runs_query_digests(spark, query):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries_streams.periodic_runs(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for doc, text in rows:
        words, h = words_of(text), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want = plain_runs(words) if len(words) < 3000 else None
        r = got[doc]
        if want is None:
            continue
        assert r["n_runs"] == len(want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
        if want:
            s, m, q = min(want, key=lambda x: (-x[1], x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, m, q, 1000 * m // q)
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
