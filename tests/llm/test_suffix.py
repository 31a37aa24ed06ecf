import hashlib
import random
from collections import Counter

import numpy as np

from ontime.llm import suffix
from tests.llm.brute import SCHEMA, odd_documents


def plain(rows):
    """The contract, string by string."""
    first = {}
    key = lambda r: float("inf") if r["doc_id"] is None else r["doc_id"]
    for r in rows:
        body = (r["text"] or "").encode()
        for i in range(len(body) - 49):
            s = body[i:i + 50]
            first[s] = min(first.get(s, key(r)), key(r))
    out = []
    for r in rows:
        body = (r["text"] or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 49):
            if first[body[i:i + 50]] < key(r):
                gone[i:i + 50] = b"\1" * 50
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((r["doc_id"], len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=90):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("lor", "ip", "dolé", "sit", "am") for b in ("em", "sum", "or", "et", "ß")]
    say = lambda k: " ".join(rng.choices(words, k=k))
    passages = [say(rng.randint(6, 40)) for _ in range(12)] + ["ab" * 60, "x" * 200, "The quick brown fox jumps over it, then rests; end. "]
    texts = []
    for i in range(n):
        text = " ".join(rng.choice([say(rng.randint(0, 30)), rng.choice(passages)]) for _ in range(rng.randint(0, 5)))
        if texts and rng.random() < 0.2:
            text = rng.choice(texts)
        if texts and rng.random() < 0.2:
            other = rng.choice(texts)
            cut = rng.randint(0, len(other))
            text = other[:cut] + rng.choice("é?x") + other[cut:]
        if i % 3 == 0:
            text = say(5) + " " + passages[0] + " " + say(7)  # one passage in a third of all rows
        texts.append(text)
    ids = rng.sample(range(-n, 3 * n), n)
    ids[5] = ids[6]
    ids[7] = None
    return [(i, t, "en", "s", 1, "a", "b", "c", "d") for i, t in zip(ids, texts)]


def test_spans_match_brute_force(spark):
    for seed, crowd, size, parts in ((1, 64, 1 << 20, 1), (2, 64, 3000, 6), (3, 3, 3000, 6)):
        docs = odd_documents(spark).unionByName(spark.createDataFrame(corpus(seed), SCHEMA)).repartition(parts)
        rows = docs.collect()
        got = Counter(tuple(r) for r in suffix.repeat_spans(docs, crowd=crowd, block_bytes=size).collect())
        assert got == Counter(plain(rows))


def test_filter_keeps_rows_and_other_columns(spark):
    docs = spark.createDataFrame(corpus(4, 60), SCHEMA)
    rows = docs.collect()
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest(), r["digest"], r["body"]) for r in out.collect())
    spans = plain(rows)
    exact = {i: sha for i, _, _, _, sha in spans}
    same = sum(n for (i, sha, digest, body), n in got.items() if exact[i] == sha and (digest, body) == ("a", "d"))
    assert same >= len(rows) - 8  # the others lost part of a character
    assert sum(got.values()) == len(rows)


def test_long_texts_are_cut_without_loss():
    rng = np.random.default_rng(3)
    whole = rng.integers(97, 101, 3 * suffix.PIECE + 17).astype(np.uint16)
    a = suffix.Anchors([whole])
    edges = [p for cut in (suffix.PIECE, 2 * suffix.PIECE) for p in range(cut - 200, cut + 200)]
    lone = suffix.Anchors([whole[suffix.PIECE - 5000: suffix.PIECE + 5000]])
    inside = {p + suffix.PIECE - 5000 for p in lone.place.tolist() if 100 < p < 9900}
    have = set(a.place.tolist())
    assert {p for p in have if suffix.PIECE - 4900 < p < suffix.PIECE + 4900} == inside and have & set(edges)
    assert len({(p, g, c) for p, g, c in zip(a.place.tolist(), a.gram.tolist(), a.context.tolist())}) == len(have)


def test_maximal_repeats_of_suffixes():
    long = bytes(range(65, 115))
    before = [b"ppq" + b"z" * 27, b"ooq" + b"z" * 27, b"z" * 30, b"k" * 30]
    onward = [long, long, long[:40] + b"!", long[:30] + b"?"]
    found = {(a, b, tuple(sorted(own.tolist()))) for a, b, own in suffix.maximal_repeats(np.zeros(4, np.int64), before, onward)}
    assert found == {(28, 50, (0, 1)), (27, 40, (0, 1, 2))}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix.repeat_spans(empty).collect() == [] and suffix.without_repeats(empty).collect() == []
