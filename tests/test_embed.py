import random
from collections import Counter

import numpy as np

from lotwise.operators import embed


def test_frequent_terms_equal_counts_of_all_grams(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["ñu", "zz"]
    texts = [[rnd.choice(vocabulary[:rnd.choice([3, 8, 32])]) for _ in range(rnd.choice([0, 1, 2, 3, 20, 60]))] for _ in range(120)]
    texts += [["aa"] * 40, ["w0", "w1"] * 30]
    uses, docs = Counter(), Counter()
    for t in texts:
        held = [" ".join(t[i:i + n]) for n in (2, 3) for i in range(len(t) - n + 1)]
        uses.update(held)
        docs.update(set(held))
    words = spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(5)
    for limit, min_df, max_df in ((10, 2, 0.8), (60, 2, 0.8), (60, 2, 0.2), (500, 3, 0.3), (100_000, 2, 1.0)):
        want = [(g, docs[g]) for g in sorted(uses, key=lambda g: (-uses[g], g.encode())) if min_df <= docs[g] <= max_df * len(texts)][:limit]
        for first, most in ((8192, 200_000), (4, 200_000), (4, 20)):
            assert embed.frequent_terms(words, len(texts), limit, min_df, max_df, first, most) == want
    assert embed.frequent_terms(words.limit(0), 0, 10, 2, 0.8) == []
    # 3-grams of rare 2-grams are not counted at all
    assert embed.gram_counts(words, vocabulary, 3, np.array([0 * 32 + 1], dtype="int64")).count() == 0
