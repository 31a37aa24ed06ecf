import hashlib
import random

import public_tokenizers as tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ontime.llm import bpe
from ontime.llm.common import table
from tests.llm.brute import SCHEMA, odd_documents

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


def test_replay_equals_lowest_rank_first_on_awkward_ranks():
    rng = random.Random(5)
    for _ in range(300):
        tokens = {bytes([b]) for b in b"abc"}
        while len(tokens) < 14:
            tokens.add(bytes(rng.choices(b"abc", k=rng.randint(2, 4))))
        order = sorted(tokens, key=len)[:3] + rng.sample(sorted(t for t in tokens if len(t) > 1), 11)
        ranks = {t: i for i, t in enumerate(order)}
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(0, 14))) for _ in range(12)]

        def plain(piece):
            parts = [piece[i:i + 1] for i in range(len(piece))]
            while True:
                pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not pairs:
                    return [ranks[p] for p in parts]
                _, i = min(pairs)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]

        assert bpe.replay(pieces, ranks, bpe.pair_table(ranks)) == [plain(p) for p in pieces]


def test_every_character_splits_as_in_the_library(library):
    texts = ["".join(f"a{chr(c)}{chr(c)}b " for c in range(at, min(at + 512, 0x30000)) if not 0xD800 <= c < 0xE000) for at in range(0, 0x30000, 512)]
    own = bpe.Encoder(PATH, tokenizers.PATTERN)
    got = [own.ids(p) for p in own.pieces(texts)]
    assert [t for t, ids in zip(texts, got) if ids != library.encode_ordinary(t)] == []


def test_documents_and_odd_rows(spark, library):
    odd = odd_documents(spark)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = sorted(
        ((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
         for r in docs.collect() for ids in [library.encode_ordinary(r.text or "")]), key=str)
    assert sorted((tuple(r) for r in bpe.round_trip(docs, PATH, tokenizers.PATTERN).collect()), key=str) == want
    encoded = bpe.encode(odd, PATH, tokenizers.PATTERN)
    back = bpe.decode(encoded.withColumn("text", F.lit("x")), PATH).collect()
    assert sorted((bytes(r.body).decode() for r in back)) == sorted(r["text"] or "" for r in odd.collect())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(empty, PATH, tokenizers.PATTERN).collect() == []
    assert bpe.decode(bpe.encode(empty, PATH, tokenizers.PATTERN), PATH).collect() == []
