"""Single-text models: the chain against brute force, codes, and tokens against the library."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lotwise.llm import language, pieces, toxicity
from cases import ODD, frame


def chain_by_hand(unary, moves):
    """Toxic marginals of one text by summing over all state sequences."""
    total, toxic = 0.0, np.zeros(len(unary))
    for states in itertools.product((0, 1), repeat=len(unary)):
        logs = moves[2][1] * states[0] + sum(u * s for u, s in zip(unary, states)) + sum(moves[a][b] for a, b in itertools.pairwise(states))
        total += np.exp(logs)
        toxic += np.exp(logs) * np.array(states)
    return toxic / total


def test_chain_marginals():
    draw = np.random.default_rng(0)
    moves = draw.normal(size=(3, 2))
    sizes = [1, 2, 7, 9, 3, 1]
    unary = draw.normal(size=sum(sizes)) * 2
    first = np.zeros(len(unary), dtype=bool)
    first[np.cumsum([0] + sizes[:-1])] = True
    got = toxicity.toxic_marginals(unary, first, moves)
    want = np.concatenate([chain_by_hand(p, moves) for p in np.split(unary, np.cumsum(sizes)[:-1])])
    assert np.allclose(got, want)
    # Many texts, far more tokens than a chunk: each alone gives the same.
    sizes = draw.integers(1, 300, 40)
    unary = draw.normal(size=sizes.sum()) * 3
    first = np.zeros(len(unary), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    whole = toxicity.toxic_marginals(unary, first, moves)
    for part, alone in zip(np.split(whole, np.cumsum(sizes)[:-1]), np.split(unary, np.cumsum(sizes)[:-1])):
        start = np.zeros(len(alone), dtype=bool)
        start[0] = True
        assert np.allclose(part, toxicity.toxic_marginals(alone, start, moves))


def toxic_texts(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = [draw.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(draw.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                words.insert(draw.randint(0, len(words)), draw.choice(["vile", "scum", "filth"]))
        out.append((" ".join(words), int(bad)))
    return out


def test_toxicity(spark):
    train, held = toxic_texts(400, 1), toxic_texts(100, 2)
    docs = frame(spark, [(i, t, "a") for i, (t, _) in enumerate(train)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(train)] + [(3, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    rows = [(i, t, "a") for i, (t, _) in enumerate(held)] + [(500 + k, t, s) for k, (_, t, s) in enumerate(ODD)]
    scored = toxicity.score(frame(spark, rows), model).collect()
    by_id = {r["row"]["doc_id"]: r for r in scored}
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)
    assert all(by_id[i]["predicted"] == y for i, (_, y) in enumerate(held))
    for i, (text, y) in enumerate(held):
        words = {w for s in by_id[i]["spans"] for w in text[s["start"]:s["stop"]].split()}
        assert bool(words) == bool(y) and words <= {"vile", "scum", "filth"}
    assert toxicity.score(frame(spark, []), model).count() == 0
    nothing = toxicity.fit(frame(spark, []), labels)
    assert {r["score"] for r in toxicity.score(frame(spark, ODD), nothing).collect()} == {0.5}


def test_language(spark):
    words = {"aa": "kalo melu tari sono".split(), "bb": "zwisch krak plotz grum".split(), "cc": "üben äthyl größe öde".split()}
    draw = random.Random(3)
    texts = [(i, " ".join(draw.choice(words[x]) for _ in range(12)), x) for i, x in enumerate(["aa", "bb", "cc"] * 40)]
    docs = frame(spark, [(i, t, "a") for i, t, _ in texts]).drop("lang").join(
        spark.createDataFrame([(i, x) for i, _, x in texts], "doc_id bigint, lang string"), "doc_id")
    held = language.held_out("doc_id", 4, 2)
    model = language.fit(docs.where(~held))
    assert model.code.shape == (3, 3) and language.codewords(2).shape == (2, 1) and language.codewords(12).shape[0] == 12
    truth = {i: x for i, _, x in texts}
    out = language.predict(docs.where(held), model).collect()
    assert len(out) > 10 and all(r["lang_pred"] == truth[r["row"]["doc_id"]] for r in out)
    odd = language.predict(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert all(r["lang_pred"] == "und" for r in odd if r["row"]["doc_id"] in (1, 2, 3))
    assert all(r["lang_pred"] != "und" for r in odd if r["row"]["doc_id"] in (4, 6, 7, 8))
    assert language.predict(frame(spark, []), model).count() == 0
    none = language.fit(docs.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    rows = docs.select("doc_id", held.alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


@pytest.fixture(scope="module")
def model_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def tricky_texts():
    draw = random.Random(1)
    out = ["", " ", "  ", "   a", "a   ", "\n\n  x", "▁x", "▁▁ x", "a　b", "<s>x</s>", "a\x00b", "日本語テキスト" * 20, "é", "\U0001F600‍",
           *[" " * n + e for n in (14, 15, 16, 17, 31, 32, 33, 48, 100) for e in ("", "x", "hello ")], "a" * 3000, "ab" * 500, "=" * 200]
    letters = "ab ▁ \néñ日\U0001F600<>0x#.,eationth"
    out += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(1500)]
    return out + ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(20, 200))) for _ in range(300)]


def test_pieces_equal_the_library(model_path):
    import sentencepiece
    with open(model_path, "rb") as file:
        model = pieces.PieceModel(file.read())
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts = tricky_texts()
    ids = library.encode(texts, add_bos=True, add_eos=True)
    packed = model.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == ids
    assert model.decode(packed) == library.decode(ids)


def test_encode_documents(spark, model_path):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out = pieces.encode_documents(frame(spark, ODD), model_path).collect()
    want = sorted(str(library.encode(t or "", add_bos=True, add_eos=True)) for _, t, _ in ODD)
    assert sorted(str(np.frombuffer(r["ids"], "<u4").tolist()) for r in out) == want
    assert sorted(r["decoded"] for r in out) == sorted(t or "" for _, t, _ in ODD)
    assert pieces.encode_documents(frame(spark, []), model_path).count() == 0
    assert pieces.encode_documents(frame(spark, ODD).select("text"), model_path, round_trip=False).where("decoded is null").count() == len(ODD)
