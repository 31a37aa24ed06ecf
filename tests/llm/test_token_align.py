"""Cross-tokenizer alignment against whole texts aligned by offsets, one by one."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from ontime.llm import token_align as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return ta.Aligner(A, B)


def spans(ids, sizes):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(sizes[i]), i))
        at += len(sizes[i])
    return out


def brute(own, rows):
    """Result rows and pair counts, each text tokenized whole."""
    aligned, counts = [], Counter()
    for key, text in rows:
        a = own.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = own.b.encode(text or "")
        body = (" " + (text or "")).encode()
        if not text or any(b"".join(side[i] for i in ids) != body for side, ids in ((own.a_bytes, a), (own.b_bytes, b))):
            aligned.append((key, None))
            continue
        left, right = spans(a, own.a_bytes), spans(b, own.b_bytes)
        links, groups, start = [], [], 0
        for end in sorted({x[1] for x in left} & {x[1] for x in right}):
            inside = [[x for x in side if start <= x[0] and x[1] <= end] for side in (left, right)]
            links += [(x[2], y[2]) for x in inside[0] for y in inside[1] if x[0] < y[1] and y[0] < x[1]]
            groups.append("|".join(",".join(str(x[2]) for x in side) for side in inside))
            start = end
        counts.update(links)
        aligned.append((key, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for key, found in aligned:
        if found is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, sha = found
            best = sum(counts[x] == highest[x[1]] for x in links)
            out.append((key, n_a, n_b, n_groups, len(links), best, sum(counts[x] for x in links), sha))
    return sorted(out, key=str), counts


PARTS = ["a", "the", "  ", "\n", " \n ", "\t ", "é", "日本", "<s>", "<|endoftext|>", "don't", "123", " ", "x  y", "\x1c ", "aaaaaaa", "ﬁ",
         "Ünïcode", "\x00", "é", "wörd,", "  ", "🙂"]


def test_like_whole_texts_one_by_one(spark, own):
    draw = random.Random(3)
    rows = [(n, "".join(draw.choice(PARTS) + draw.choice(["", " "]) for _ in range(draw.randint(0, 25)))) for n in range(300)]
    rows += [(400, None), (401, ""), (402, " "), (403, "a "), (404, "  "), (None, "the the"), (405, "the the"), (405, "the the"),
             (406, "blank ▁ sign"), (407, "long " * 4000 + "x" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, counts = brute(own, rows)
    assert sorted(map(tuple, ta.align(docs, A, B, block_bytes=700).collect()), key=str) == want
    assert sorted(map(tuple, ta.align(docs, A, B).collect()), key=str) == want
    pairs = ta.Counts(docs, A, B, block_bytes=700)
    assert {(r.a_id, r.b_id): r.n for r in pairs.table().collect()} == counts
    pairs.close()


def test_chunks_end_where_both_tokenizers_do(own):
    assert own.cuts
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice(PARTS) for _ in range(12))
        chunks = ta.chunks_of(text)
        assert "".join(" " + c for c in chunks) == " " + text
        whole = own.a.encode(" " + text, add_special_tokens=False).ids
        assert whole == [i for c in chunks for i in own.a.encode(" " + c, add_special_tokens=False).ids]


def test_texts_in_one_piece_give_the_same():
    cut, uncut = ta.Aligner(A, B), ta.Aligner(A, B)
    uncut.cuts = False

    def groups(aligner, text):
        at = [(n + 1) * ta.COLUMNS for n in aligner.numbers([text])[0].tolist()]
        table = [0] * ta.COLUMNS + list(aligner.sizes)
        return b"".join(aligner.groups[table[i - 1]:table[i + ta.COLUMNS - 1]] for i in at)

    for text in ("one two  three\n four", "two two", " ", ""):
        assert groups(cut, text) == groups(uncut, text)


def test_identity_map(own):
    for a in (0, 100, 262, 5000, 50255):
        b = int(own.identity[a])
        assert b < 0 or own.b_bytes[b] == own.a_bytes[a]
    same = set(own.b_bytes[259:])
    assert all(own.identity[a] >= 0 for a, body in enumerate(own.a_bytes) if body in same)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align(empty, A, B).collect() == []
    docs = spark.createDataFrame([(7, "hello there", 1, "x", 2)], "doc_id long, text string, block long, answers string, code long")
    assert ta.align(docs, A, B).first().n_groups == 2
