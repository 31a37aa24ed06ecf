import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import rules
from tests.llm.brute import SCHEMA, odd_documents

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(text):
    text = text or ""
    words = split(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if split(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


def test_statistics_match_plain_counting(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["a", "b", "cé", "d#", "|", "x\n", "\n"], k=rng.randint(0, 120))) for _ in range(60)]
    docs = odd_documents(spark).unionByName(spark.createDataFrame(
        [(100 + i, t, "en", "s", 1, "", "", "", "") for i, t in enumerate(texts)], SCHEMA))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.statistics(docs).collect())
    assert got == Counter((r["doc_id"], *plain(r["text"])) for r in docs.collect())


def test_chi_square():
    assert math.isclose(rules.chi_square_quantile(0.975, 5), 12.8325, rel_tol=1e-5)
    assert math.isclose(rules.chi_square_cdf(3.0, 2), 1 - math.exp(-1.5), rel_tol=1e-12)


def brute_estimates(x, parts, share):
    """The same estimator for one cell, row by row: distances, and the determinants along the way of every start."""
    least = np.square(rules.LEAST_SPREADS)

    def binned(v):
        return (np.floor(v * rules.BINS_PER_UNIT) + 0.5) / rules.BINS_PER_UNIT

    def median(v):
        return np.sort(binned(v))[-(-len(v) // 2) - 1]

    def sums(y, factor):
        mean = y.mean(axis=0)
        cov = factor * ((y[:, :, None] * y[:, None, :]).mean(axis=0) - np.outer(mean, mean))
        np.fill_diagonal(cov, np.maximum(np.diag(cov), least))
        return mean, cov

    def distances(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def step(mean, cov):
        b = np.floor(rules.BINS_PER_E * np.log(np.maximum(distances(mean, cov), rules.LEAST_DISTANCE)))
        limit = next(v for v in np.unique(b) if (b <= v).sum() >= share * len(x))
        return sums(x[b <= limit], rules._consistency(share))

    middle = np.array([median(c) for c in x.T])
    spread = np.array([1.4826 * median(np.abs(binned(c) - m)) for c, m in zip(x.T, middle)]) ** 2
    starts = [(middle, np.diag(np.maximum(spread, least))), sums(x, 1.0), *[sums(x[parts == k], 1.0) for k in range(rules.HASH_STARTS) if (parts == k).any()]]
    ends = []
    for state in starts:
        state = step(*state)
        while True:
            after = step(*state)
            if not np.linalg.slogdet(after[1])[1] < np.linalg.slogdet(state[1])[1] - rules.SETTLED:
                break
            state = after
        ends.append(state)
    best = min(ends, key=lambda e: round(np.linalg.slogdet(e[1])[1], 6))
    return distances(*sums(x[distances(*best) <= rules.chi_square_quantile(0.975, rules.P)], rules._consistency(0.975)))


def test_verdicts_match_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["ab", "cde", "fghij", "k#", "lm|", "nop"] + [f"w{i}" for i in range(400)]
    rows = []
    for i in range(900):
        text = " ".join(rng.choice(words, rng.integers(55, 400)))
        if i % 50 == 0:
            text = " ".join(w + "***" for w in split(text))
        rows.append((1000 + i, text, ["en", "de", None][i % 3], ["big", "big", None, f"s{i % 7}"][i % 4], 1, "", "", "", ""))
    docs = odd_documents(spark).unionByName(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in rules.verdicts(docs).collect() if r.doc_id is not None and r.doc_id != 8}
    sound = [(r["doc_id"], r["lang"], r["source"], plain(r["text"])) for r in docs.collect()]
    assert all(got[i].base_failed == (s[0] < 50 or 100 * s[4] > 50 * s[0]) for i, _, _, s in sound if i in got)
    sound = [r for r in sound if r[0] in got and not got[r[0]].base_failed]
    x = np.array([[math.log(s[0]), math.log(s[1] / s[0]), math.log1p(1000 * s[2] / s[1]), math.log1p(1000 * s[3] / s[0]), math.log1p(100 * s[4] / s[0])]
                  for *_, s in sound])
    # the same numbers to the last bit, and the parts that their hashes put rows in
    part = F.pmod(F.xxhash64(F.lit("start"), *rules.X), F.lit(rules.HASH_PARTS))
    own = {r[0]: r for r in rules.staged(rules.statistics(docs), "own").where(~rules.base_failed()).withColumns(dict(zip(rules.X, rules.vector()))).select("doc_id", part, *rules.X).collect()}
    assert np.allclose(x, [own[i][2:] for i, *_ in sound])
    x, parts = np.array([own[i][2:] for i, *_ in sound]), np.array([own[i][1] for i, *_ in sound])
    pair, lang = Counter((a, b) for _, a, b, _ in sound), Counter(a for _, a, _, _ in sound)
    chosen = [(a, b) if pair[a, b] >= 100 else (a,) if lang[a] >= 100 else () for _, a, b, _ in sound]
    for cell in set(chosen):
        inside = [k for k, (_, a, b, _) in enumerate(sound) if (a, b)[: len(cell)] == cell]
        distance = dict(zip(inside, brute_estimates(x[inside], parts[inside], 0.75)))
        for k, own in enumerate(chosen):
            if own == cell:
                row = got[sound[k][0]]
                assert math.isclose(row.distance, distance[k], rel_tol=1e-6, abs_tol=1e-9)
                assert row.kept == (distance[k] <= rules.chi_square_quantile(rules.USUAL_CUTOFF, rules.P))
    junk = {1000 + i for i in range(0, 900, 50)}
    lost = {i for i, r in got.items() if not r.base_failed and not r.kept}
    assert junk <= lost and len(lost - junk) <= 18  # two in a hundred sound ones at most


def test_states_that_take_turns_come_to_rest(spark):
    """Whole bins can let two subsets take turns; ties, a constant statistic and several cells at once. No determinant ever rises."""
    rng = np.random.default_rng(17)
    rows = []
    for cell in range(12):
        x = rng.normal(0, 1, (rng.integers(8, 60), 5)).round(1)  # many ties
        x[:, 3] = 0.0 if cell % 2 else x[:, 3]
        rows += [(f"c{cell}", 0, *map(float, r)) for r in np.concatenate([x, x[:5]])]
    levels = rules.staged(spark.createDataFrame(rows, ["cell", "slice", *rules.X]), "levels")
    slices = levels.select("cell", "slice").distinct()
    best = rules._settled(levels, slices, 0.75)
    assert best.count() == 12
    last = {r.cell: r.log_det for r in best.collect()}
    for r in rules._concentrate(levels, best.drop("log_det").join(slices, "cell"), 0.75).collect():
        assert r.log_det >= last[r.cell] - rules.SETTLED


def test_filter_and_empty_table(spark):
    docs = odd_documents(spark)
    kept = rules.sound_documents(docs)
    assert kept.columns == docs.columns and kept.collect() == []
    empty = spark.createDataFrame([], SCHEMA)
    assert rules.verdicts(empty).collect() == [] and rules.sound_documents(empty).collect() == []


def test_each_statistic_can_reject_alone(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" + "x" * (i % 7) for i in range(500)]
    texts = [" ".join(rng.choice(words, rng.integers(150, 400))) for _ in range(400)]
    plain_text = texts[0]
    odd = [" ".join(f"{i:03d}" + "z" * 22 for i in range(250)),
           plain_text + "$" * (len(plain_text) // 25), plain_text + "\nsame" * 40]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "", "", "", "") for i, t in enumerate(texts + odd)], SCHEMA)
    got = {r.doc_id: r for r in rules.verdicts(docs).collect()}
    assert not any(got[400 + i].base_failed or got[400 + i].kept for i in range(3))
    assert sum(got[i].kept for i in range(400)) >= 390


def test_steps_settle_at_the_smallest_determinant_of_all_starts(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1.0, (300, 5)), rng.normal(8, 0.6, (100, 5))])
    levels = spark.createDataFrame([("c", 0, *map(float, r)) for r in x], ["cell", "slice", *rules.X])
    slices = levels.select("cell", "slice").distinct()
    best = rules._settled(levels, slices, 0.75).collect()[0]
    again = rules._concentrate(levels, spark.createDataFrame([best]).drop("log_det").join(slices, "cell"), 0.75).collect()[0]
    assert again.log_det >= best.log_det - rules.SETTLED
    starts = rules.staged(rules._starts(levels), "starts")
    assert {r.start for r in starts.collect()} == {0, 1, 2, 3}
    for one in rules._concentrate(levels, starts.join(slices, "cell"), 0.75).collect():
        assert best.log_det <= one.log_det + 1e-5
    sound = np.linalg.slogdet(np.cov(x[:300].T, ddof=0))[1] + 5 * math.log(rules._consistency(0.75))
    assert math.isclose(best.log_det, sound, abs_tol=1e-3)
