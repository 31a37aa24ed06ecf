import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from ontime.llm import lm
from tests.llm.brute import SCHEMA, WORDS, odd_documents

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Plain:
    """The model in dictionaries."""

    def __init__(self, texts):
        self.r, self.c, self.h = Counter(), Counter(), Counter()
        for words in texts:
            tokens = [*words, "end"]
            self.c.update(tokens)
            self.h.update(["start", *words])
            self.r.update(zip(["start", *words], tokens))
        self.n, self.v = sum(self.c.values()), len(self.c)
        kinds = lambda counts: [sum(x == i for x in counts.values()) for i in range(1, lm.TRUSTED + 2)]
        self.d2, self.d1 = lm.katz_discounts(kinds(self.r)), lm.katz_discounts(kinds(self.c))
        self.keep = lambda x, d: d[x] if x <= lm.TRUSTED else x - lm.LEFT_OVER
        self.unknown = 1 - sum(self.keep(x, self.d1) for x in self.c.values()) / self.n if self.n else 1.0
        self.after = defaultdict(list)
        for h, w in self.r:
            self.after[h].append(w)

    def word(self, w):
        return self.keep(self.c[w], self.d1) / self.n if self.c[w] else self.unknown

    def pair(self, h, w):
        if self.r[h, w]:
            return self.keep(self.r[h, w], self.d2) / self.h[h]
        if not self.h[h]:
            return self.word(w)
        left = 1 - sum(self.keep(self.r[h, x], self.d2) for x in self.after[h]) / self.h[h]
        return left / (1 - sum(map(self.word, self.after[h]))) * self.word(w)


def words_of(text):
    return WORDS.findall((text or "").encode().translate(LOWER))


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


def corpus(n=150, seed=8):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(0.7))}" for _ in range(900)] + ["The", "of", "É"]
    return [(1000 + i, " ".join(rng.choices(pool, k=rng.randint(0, 60))), "en", "s", 1, "", "", "", "") for i in range(n)]


def compare(docs, got):
    rows = docs.collect()
    model = Plain([words_of(r["text"]) for r in rows if not held(r["doc_id"])])
    want = []
    for r in rows:
        words = words_of(r["text"])
        tokens = [*words, "end"]
        base = sum(math.log10((model.c[t] + 1) / (model.n + model.v + 1)) for t in tokens)
        score = sum(math.log10(model.pair(h, t)) for h, t in zip(["start", *words], tokens))
        want.append((str(r["doc_id"]), held(r["doc_id"]), len(tokens), sum(model.c[t] > 0 for t in tokens), model.n, base, score))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    want.sort()
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-7, abs_tol=1e-7), (g, w)
    return model


def test_scores_match_plain_counting(spark):
    docs = odd_documents(spark).unionByName(spark.createDataFrame(corpus(), SCHEMA))
    model = compare(docs, lm.scores(docs).collect())
    compare(docs, lm.katz_scores(docs.repartition(7), lm.crc_mod(docs["doc_id"], 7) == 2, block_bytes=2000).collect())
    vocabulary = list(model.c)
    for h in ["start", b"w1", b"the", b"never seen", *random.Random(1).sample(list(model.h), 20)]:
        total = sum(model.pair(h, w) for w in vocabulary) + model.pair(h, "unknown")
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_better_than_the_base_on_unseen_texts(spark):
    rows = [r for r in lm.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_training_text_and_empty_table(spark):
    docs = odd_documents(spark)
    from pyspark.sql import functions as F
    got = lm.katz_scores(docs, F.lit(True)).collect()
    assert len(got) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in got)
    assert lm.scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_discounts():
    d = lm.katz_discounts([100, 40, 22, 14, 10, 8])
    assert np.all(np.diff(d) > 0) and np.all(d[1:] < np.arange(1, 6)) and d[0] == 0
    assert np.allclose(lm.katz_discounts([0] * 6)[1:], np.arange(1, 6) - lm.LEFT_OVER)
