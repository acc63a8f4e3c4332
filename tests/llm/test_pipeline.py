"""The stages in turn against plain Python on a small corpus."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline
from lotwise.llm import lines
from cases import frame
from test_native import waterfill
from test_pairs import all_pairs


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(260):
        text = "\n".join(" ".join(draw.choice(words) for _ in range(draw.randint(8, 40))) for _ in range(3))
        if i % 6 == 0:
            text += " " + draw.choice(["vile scum", "filth vile", "scum filth"])
        if i % 2:
            text += "\nall rights of this site are kept by the site"
        rows.append((i, text, f"s{i % 9}"))
    for k in range(12):                             # near copies of clean documents
        i, text, _ = rows[6 * k + 1]
        rows.append((300 + k, text.replace("w7", "w8", 1), "s1"))
    rows += [(400, None, "s2"), (401, "", None), (402, rows[1][1], "s3"), (None, "lonely words without an id", "s3")]
    folder = tmp_path_factory.mktemp("corpus")
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(any(x in t for x in ("vile", "scum", "filth")))) for i, t, _ in rows[:260]]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def plain(rows):
    """What the first three stages leave."""
    rows = [r for r in rows if not any(x in (r[1] or "") for x in ("vile", "scum", "filth"))]
    sites, holder = defaultdict(set), {}
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            bare = line.strip(" \t\r")
            sites[bare].add(s)
            if i is not None:
                holder[bare] = min(holder.get(bare, i), i)
    gone = {x for x, s in sites.items() if x and len(s - {None}) >= lines.MIN_SITES}
    assert gone
    def left(i, t):
        now = "\n".join(x for x in t.split("\n") if x.strip(" \t\r") not in gone or holder[x.strip(" \t\r")] == i)
        shared = sum(len(x) for x in t.split("\n") if x.strip(" \t\r") and len(sites[x.strip(" \t\r")] - {None}) > 1)
        return t if shared > corpus_pipeline.SPARED * len(t) else now
    rows = [(i, None if t is None else left(i, t), s) for i, t, s in rows]
    return [r for r, (_, root) in zip(rows, all_pairs(rows), strict=True) if r[0] == root or not (r[1] or "").split()]


def test_stages(spark, corpus):
    folder, rows = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        seen[name] = docs.collect()
        assert name == "sentencepiece" or docs.columns == columns
    left = plain(rows)
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in seen["ngram_jaccard_join"])
    assert got == sorted((i or -1, t or "") for i, t, _ in left)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, s in left:
        sizes[s] += len((t or "").split())
        longest[s] = max(longest[s], len((t or "").split()))
    for r in seen["mix_sources"]:
        taken[r["source"]] += len((r["text"] or "").split())
    target = waterfill(sizes)
    assert all(abs(taken[s] - target[s]) <= longest[s] + 1e-6 for s in sizes)
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.tokenizer_path())
    assert len(seen["sentencepiece"]) == len(seen["mix_sources"])
    assert sorted(r["decoded"] for r in seen["sentencepiece"]) == sorted(r["text"] or "" for r in seen["mix_sources"])
    for r in seen["sentencepiece"]:
        assert r["n_tokens"] == len(library.encode(r["decoded"], add_bos=True, add_eos=True)) == len(r["ids"]) // 4


def test_run_equals_the_stages(spark, corpus):
    folder, _ = corpus
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "n_tokens", "ids", "decoded"} <= set(out.columns) and out.count() > 100


def test_copies_on_many_sources(spark, tmp_path):
    draw = random.Random(31)

    def text():
        return "\n".join(" ".join(f"v{draw.randint(0, 5000)}" for _ in range(25)) for _ in range(6))

    groups, rows = {}, []
    for g in range(6):                              # exact copies, then near ones with three words edited, on 10 sources
        base = text()
        for k in range(10):
            words = base.split(" ")
            for _ in range(3 if g >= 3 and k else 0):
                at = draw.randrange(len(words))
                words[at] = words[at].replace("v", "edited")
            i = 100 * g + k
            groups[i] = g
            rows.append((i, " ".join(words), f"s{k}"))
    footer = "all rights of this site are kept by the site"
    rows += [(1000 + k, text() + "\n" + footer, f"s{k % 10}") for k in range(30)]      # a shared line only: all stay
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    was = {i: t for i, t, _ in rows}
    stages = dict(corpus_pipeline.STAGES)
    for name in ("line_dedup", "ngram_jaccard_join"):
        docs = corpus_pipeline.materialize(stages[name](spark, docs, str(tmp_path)), name)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(i for i in left if i < 1000) == [100 * g for g in range(6)]
    assert all(left[100 * g] == was[100 * g] for g in range(6))
    assert {i for i in left if i >= 1000} == set(range(1000, 1030))
    assert sum(footer in t for t in left.values()) == 1


def test_empty_documents(spark, tmp_path):
    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
