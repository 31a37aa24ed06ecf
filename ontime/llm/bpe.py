"""Byte-level BPE by merge replay over the distinct pieces of a block of documents.

A task reads its documents in blocks, splits them by the pattern and collects the distinct pieces it has not encoded yet.
All of them are laid out in one array of bytes, and an inverted index holds, for each rank, the positions where a
neighbouring pair makes that token. Ranks are replayed from the lowest up; a merge rewrites the two neighbouring pairs
of its position and nothing else. If a merge makes a pair of a lower rank than the one in progress, the rest of that piece
waits until the lower rank was replayed, so each piece sees its merges lowest rank first, leftmost first. No row moves
between tasks; the memory of a task is one block, its pieces and a bounded cache of encoded pieces.

Defined results: null text counts as empty and has no tokens; texts that look like special tokens are ordinary text; rows
that repeat are encoded again; an empty table gives an empty result; a null id stays null; other columns are not read. A
piece of any length is replayed whole.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import named

BLOCK_CHARS = 4_000_000
CACHED_PIECES = 500_000

#: Token ids are below 1 << SHIFT; the two last of that range mark the gap between pieces and a token merged away.
SHIFT = 20
GAP, MERGED = (1 << SHIFT) - 1, (1 << SHIFT) - 2


@lru_cache(2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(2)
def tokens_of(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks_of(path).items()}


@lru_cache(2)
def pairs_of(path: str) -> dict[int, int]:
    """Every pair of tokens that make a token, as left << SHIFT | right, with that token."""
    return pair_table(ranks_of(path))


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[left << SHIFT | right] = rank
    return found


@lru_cache(2)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def replay(pieces: list[bytes], ranks: dict[bytes, int], pairs: dict[int, int]) -> list[list[int]]:
    """Token ids of each piece. Pieces lie in one array of tokens with a gap, which pairs with nothing, before each."""
    single = [ranks.get(bytes([b]), GAP) for b in range(256)]
    token: list[int] = [GAP]
    for piece in pieces:
        token += map(single.__getitem__, piece)
        token.append(GAP)
    size = len(token)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    find = pairs.get
    makes = [find(a << SHIFT | b, -1) for a, b in zip(token, token[1:])] + [-1]  # what a token and its next one make
    places: list[list[int] | None] = [None] * (1 + max(ranks.values(), default=0))
    for at, rank in enumerate(makes):
        if rank >= 0:
            held = places[rank]
            if held is None:
                places[rank] = [at]
            else:
                held.append(at)
    gaps: list[int] = []  # made when a piece first has to wait
    rank, last = 0, len(places)
    while rank < last:
        found = places[rank]
        if found is None:
            rank += 1
            continue
        places[rank] = None
        found.sort()
        lowest, wait_until = rank, -1
        for i in found:
            if makes[i] != rank:
                continue
            if i < wait_until:
                held = places[rank]
                if held is None:
                    places[rank] = [i]
                else:
                    held.append(i)
                continue
            j = after[i]
            k = after[j]
            h = before[i]
            token[i], token[j], makes[j] = rank, MERGED, -1
            after[i] = k
            before[k] = i
            makes[i] = right = find(rank << SHIFT | token[k], -1)
            if right >= 0:
                held = places[right]
                if held is None:
                    places[right] = [i]
                else:
                    held.append(i)
            makes[h] = left = find(token[h] << SHIFT | rank, -1)
            if left >= 0:
                held = places[left]
                if held is None:
                    places[left] = [h]
                else:
                    held.append(h)
            if -1 < left < rank or -1 < right < rank:  # the rest of this piece comes after the lower rank
                lowest = min(x for x in (lowest, left, right) if x >= 0)
                gaps = gaps or [n for n, t in enumerate(token) if t == GAP]
                wait_until = gaps[bisect(gaps, i)]
        rank = lowest if lowest < rank or places[rank] else rank + 1
    out, at = [], 1
    for piece in pieces:
        out.append([t for t in token[at: at + len(piece)] if t != MERGED])
        at += len(piece) + 1
    return out


class Encoder:
    """Packed ids, the ids' decimal text and the decoded bytes of pieces, kept for the pieces to come."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.tokens, self.pairs, self.split = ranks_of(path), tokens_of(path), pairs_of(path), splitter(pattern).findall
        self.known: dict[str, tuple[bytes, str, bytes]] = {}

    def pieces(self, texts: Iterable[str]) -> list[list[str]]:
        """The pieces of one block of texts; all of them are known afterwards."""
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        pieces = [self.split(text) for text in texts]
        new = set(chain.from_iterable(pieces)).difference(self.known)
        whole = {p: self.ranks.get(p.encode()) for p in new}
        rest = [p for p, rank in whole.items() if rank is None]
        ids = {p: [rank] for p, rank in whole.items() if rank is not None}
        ids.update(zip(rest, replay([p.encode() for p in rest], self.ranks, self.pairs)))
        for p, own in ids.items():
            self.known[p] = array("i", own).tobytes(), ",".join(map(str, own)), self.decode(own)
        return pieces

    def ids(self, pieces: list[str]) -> list[int]:
        return array("i", b"".join([self.known[p][0] for p in pieces])).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, so later tasks start with the pieces of earlier ones."""
    return Encoder(path, pattern)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows in blocks of about BLOCK_CHARS characters, one row at least."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= BLOCK_CHARS or i + 1 == len(texts):
                yield batch.column("doc_id").slice(start, i + 1 - start), texts[start: i + 1]
                start, size = i + 1, 0


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of each whole text."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for key, texts in _blocks(batches):
            ids = pa.array(map(own.ids, own.pieces(texts)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([key, ids], ["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, body: the bytes that the ids stand for; null ids count as none."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens_of(path).__getitem__
        for batch in batches:
            bodies = [b"".join(map(token, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    rows = tokens.select(named(id_col).cast("long").alias("doc_id"), named(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(decoded, "doc_id long, body binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded, both as digests.

    The ids stay in the task that made them, so only the digests travel. Ids are decoded once per distinct piece.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for key, texts in _blocks(batches):
            counts, shas, bodies = [], [], []
            for pieces in own.pieces(texts):
                ids, decimal, decoded = zip(*map(own.known.__getitem__, pieces)) if pieces else ((), (), ())
                counts.append(len(b"".join(ids)) // array("i").itemsize)
                shas.append(hashlib.sha256(",".join(decimal).encode()).hexdigest())
                bodies.append(hashlib.sha256(b"".join(decoded)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(bodies, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_col, text_col).mapInArrow(
        digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
