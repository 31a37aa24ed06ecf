"""Alignment of two tokenizations of the same texts, with an identity map as the fast path.

A text is cut into *chunks* before each blank that follows a character other than white space. Byte-level BPE always ends a
token there, and so does the piece model if none of its pieces holds a blank behind another character; then every chunk is
tokenized and aligned alone, once per worker, and a text is the row of its chunks. (For other models a text is one chunk.)

The *identity map* is an array that gives, for each id of tokenizer A, the id of B with the same bytes. A group of one
token each that it holds is *regular*: a task counts such groups in a vector as long as A's vocabulary. Only the links
of all other groups are shuffled as pairs.

1. Documents become blocks (see blocks.py): one row each with the texts' counts and digests, their chunks as numbers and
   the chunks' links as numbers of distinct pairs.
2. The vectors and the pairs of all blocks are summed. Vectors as long as a vocabulary, the totals of identity pairs and
   the highest total of each B id, go to all tasks; every other total goes back to the blocks that hold the pair.
3. Each block, now knowing all its totals, sums them over the links of its texts.

Defined results: a text that is null, empty, or whose joined tokens of either side differ from a space and the text, has
no tokens: zeros and an empty digest, and it counts no links. Texts of any length are read whole; rows that repeat are
aligned and counted again; a null id stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.blocks import BLOCK_BYTES, each_block, forget, home, pack_rows, unpack_rows
from ontime.llm.common import ids_and_bytes, staged, text_bytes

#: Smaller blocks than other operators': links and group texts of a block are several times its size in memory.
ALIGN_BYTES = BLOCK_BYTES // 2

#: A worker forgets its chunks, between two blocks, beyond so many; they are then tokenized again when they come back.
CACHED_CHUNKS = 400_000

#: Chunks that are tokenized as one text.
JOINED = 1_000

#: Numbers kept of each chunk.
COLUMNS = 6

#: Every character that Python counts as white space, and so every one that a tokenizer's pattern does, before a blank.
_RUNS = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]
_CHUNK = re.compile(r" (?:[^ ]|(?<=\s) )*")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, then from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def chunks_of(text: str) -> list[str]:
    """The chunks of a space and the text, each without its leading blank."""
    spaced = " " + text
    if any(run in spaced for run in _RUNS):
        return [chunk[1:] for chunk in _CHUNK.findall(spaced)]
    return text.split(" ")


class Aligner:
    """Both vocabularies, and the chunks that this worker has aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, at in self.a.get_vocab().items():
            own = [letters.get(c) for c in token]
            self.a_bytes[at] = token.encode() if None in own else bytes(own)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        of_bytes: dict[bytes, int] = {}
        for wanted in (self.b.is_byte, lambda i: not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))):
            of_bytes.update((self.b_bytes[i], i) for i in range(len(pieces)) if wanted(i))  # a piece goes before a byte
        self.identity = np.array([of_bytes.get(own, -1) for own in self.a_bytes], np.int64)
        self.width = len(pieces)
        self.lengths = tuple(np.array(list(map(len, own)), np.int64) for own in (self.a_bytes, self.b_bytes))
        # decimal ids: inside and at the end of their part of a group
        self.texts = tuple(np.array([[b"%d%s" % (i, mark) for i in range(len(own))] for mark in (b",", last)], object)
                           for own, last in ((self.a_bytes, b"|"), (self.b_bytes, b";")))
        with open(a_path) as file:
            split = json.load(file).get("pre_tokenizer") or {}
        byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.cuts = bool(byte_level) and not any(re.search("[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups = bytearray()  # as text, a semicolon behind each
        self.sizes = array("q")  # n_a, n_b, n_groups, whether the bytes agree, links so far, length of the groups' text so far
        self.codes, self.regular = array("q"), array("b")

    def chunks(self, text: str) -> list[str]:
        return chunks_of(text) if self.cuts else [text]

    def b_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of a space and each chunk; the processor adds that space itself, unless nothing follows it."""
        ids = self.b.encode(chunks, num_threads=1)
        for n, chunk in enumerate(chunks):
            if not chunk:
                ids[n] = [self.b.piece_to_id("▁")]
        return ids

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The chunks of each text as numbers; all of them are known afterwards."""
        number, new, found = self.number, [], []
        for text in texts:
            chunks = self.chunks(text) if text else []
            for chunk in set(chunks).difference(number):
                new.append(chunk)
                number[chunk] = -len(new)  # until it has a number of its own
            found.append(np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks)))
        self.learn(new)
        own = np.array([number[chunk] for chunk in new], np.int64)
        for at in found:
            if len(own):
                at[at < 0] = own[-1 - at[at < 0]]
        return found

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that are not known yet. Those that may stand side by side are tokenized as texts of many chunks."""
        sure = [chunk for chunk in chunks if chunk and not chunk[-1].isspace() and "▁" not in chunk] if self.cuts else []
        others = set(chunks).difference(sure)
        texts = ["".join([" " + chunk for chunk in sure[at: at + JOINED]]) for at in range(0, len(sure), JOINED)]
        a_ids, b_ids = [], []
        for text in texts:  # the tokenizers' own structures are many times a text's size
            a_ids += [np.array(each.ids, np.int32) for each in self.a.encode_batch_fast([text], add_special_tokens=False)]
            b_ids.append(np.array(self.b.encode(text[1:]), np.int32))
        a, b = (np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64) for ids in (a_ids, b_ids))
        sizes = np.array([len(chunk.encode()) + 1 for chunk in sure], np.int64)
        body = "".join(texts).encode()
        if all(b"".join(map(own.__getitem__, ids.tolist())) == body for own, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            ends = np.cumsum(sizes)
            a_count, b_count = (np.diff(np.searchsorted(np.cumsum(length[ids]), ends) + 1, prepend=0) for length, ids in zip(self.lengths, (a, b)))
            self._add(sure, a, b, a_count, b_count, np.ones(len(sure), bool))
        else:
            others.update(sure)
        if others:
            self._learn_alone(list(others))

    def _learn_alone(self, chunks: list[str]) -> None:
        """Tokenize each chunk by itself and see whether both sides give its bytes."""
        spaced = [" " + chunk for chunk in chunks]
        a, a_count = _flat([each.ids for each in self.a.encode_batch_fast(spaced, add_special_tokens=False)])
        b, b_count = _flat(self.b_ids(chunks))
        fine = np.ones(len(chunks), bool)
        for own, ids, count in ((self.a_bytes, a, a_count), (self.b_bytes, b, b_count)):
            parts, stop = list(map(own.__getitem__, ids.tolist())), np.cumsum(count).tolist()
            fine &= np.array([b"".join(parts[start:end]) == body.encode() for start, end, body in zip([0, *stop], stop, spaced)], bool)
        self._add(chunks, a[np.repeat(fine, a_count)], b[np.repeat(fine, b_count)], a_count * fine, b_count * fine, fine)

    def _add(self, chunks: list[str], a: np.ndarray, b: np.ndarray, a_count: np.ndarray, b_count: np.ndarray, fine: np.ndarray) -> None:
        """Align the tokens of chunks, all in one go: laid end to end, every chunk ends with a common end."""
        known = len(self.sizes) // COLUMNS
        self.number.update(zip(chunks, range(known, known + len(chunks))))
        a_end, b_end = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        ends = np.union1d(a_end, b_end)  # between two ends lies one link
        a_at, b_at = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        common = (a_end[a_at] == ends) & (b_end[b_at] == ends) if len(ends) else np.zeros(0, bool)
        group = np.cumsum(common) - common  # of each link
        n_groups = int(common.sum())
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[a_at[common]] = True
        b_last[b_at[common]] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        regular = (np.bincount(group, minlength=n_groups) == 1)[group] & (self.identity[a[a_at]] == b[b_at])
        # the groups as text: A's tokens of a group, then B's
        out = np.empty(len(a) + len(b), object)
        a_upto = np.searchsorted(a_group, np.arange(n_groups), "right")
        b_upto = np.searchsorted(b_group, np.arange(n_groups), "right")
        out[np.arange(len(a)) + np.concatenate([[0], b_upto])[a_group]] = self.texts[0][a_last.astype(np.int8), a]
        out[np.arange(len(b)) + a_upto[b_group]] = self.texts[1][b_last.astype(np.int8), b]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        texts = len(self.groups) + np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(a_count + b_count)]
        self.groups += b"".join(out)
        # per chunk
        chunk = np.repeat(np.arange(len(fine)), a_count)[a_at]  # of each link
        links = np.bincount(chunk, minlength=len(fine))
        table = np.stack([a_count, b_count, np.bincount(chunk[common], minlength=len(fine)), fine.astype(np.int64),
                          len(self.codes) + np.cumsum(links), texts], axis=1).astype(np.int64)
        self.sizes.frombytes(table.tobytes())
        self.codes.frombytes((a[a_at] * self.width + b[b_at]).tobytes())
        self.regular.frombytes(regular.astype(np.int8).tobytes())


@lru_cache(1)
def _trim():
    """glibc's malloc_trim, or nothing where there is none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: None)


def give_back() -> None:
    """Return memory that the last block needed: workers live on, and executors count it."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


@lru_cache(2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker, so later tasks start with the chunks of earlier ones."""
    return Aligner(a_path, b_path)


def _describe(a_path: str, b_path: str):
    """Packed arrays of a block: see the module text. ``kinds`` are the distinct pairs of its links."""

    def described(block: pa.Table) -> dict[str, bytes]:
        own = aligner(a_path, b_path)
        if len(own.number) > CACHED_CHUNKS:
            own.forget()
        lists = own.numbers([body.decode() for body in block.column("body").to_pylist()])
        ends = np.cumsum([len(each) for each in lists])
        seen, chunk = np.unique(np.concatenate(lists), return_inverse=True)
        del lists
        table = np.array(own.sizes, np.int64).reshape(-1, COLUMNS)
        sizes, (starts, first), (stops, last) = table[seen, :4], np.where(seen > 0, table[seen - 1, 4:].T, 0), table[seen, 4:].T
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        whole = (np.bincount(text, weights=sizes[chunk, 3] == 0, minlength=len(ends)) == 0) & (np.diff(ends, prepend=0) > 0)
        sums = [(np.bincount(text, weights=sizes[chunk, k], minlength=len(ends)) * whole).astype(np.int64) for k in range(3)]
        groups = [bytes(own.groups[start:end]) for start, end in zip(first.tolist(), last.tolist())]
        shas, at = [], 0
        for end, fine in zip(ends.tolist(), whole.tolist()):
            shas.append(hashlib.sha256(b"".join([groups[n] for n in chunk[at:end].tolist()])[:-1]).hexdigest() if fine else "")
            at = end
        # links of the block's chunks, chunk after chunk
        lengths = stops - starts
        place = np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        codes, regular = np.array(own.codes, np.int64)[place], np.array(own.regular, np.int8)[place] == 1
        kinds, kind = np.unique(codes, return_inverse=True)
        times = np.repeat(np.bincount(chunk, weights=whole[text], minlength=len(seen)), lengths)
        count = lambda which: np.bincount(kind[which], weights=times[which], minlength=len(kinds)).astype(np.int64)
        rows = pa.table({"doc_id": block.column("doc_id"), "n_a": sums[0], "n_b": sums[1], "n_groups": sums[2],
                         "groups_sha256": shas, "end": ends.astype(np.int64), "whole": whole})
        arrays = {"texts": rows, "chunks": pa.table({"chunk": chunk.astype(np.int32)}),
                  "links": pa.table({"kind": kind.astype(np.int32), "chunk": np.repeat(np.arange(len(seen), dtype=np.int32), lengths)}),
                  "kinds": pa.table({"code": kinds, "regular": count(regular), "pairs": count(~regular)})}
        packed = {name: pack_rows(value) for name, value in arrays.items()}
        del arrays, rows, place, codes, regular, kinds, kind, times, groups
        give_back()
        return packed

    return described


def _vectors(width: int, identity: np.ndarray):
    """(code, n): the non-zero entries of a task's vector of regular groups."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(identity), np.int64)
        for (kinds,) in each_block(batches, ["kinds"]):
            table = unpack_rows(kinds)
            regular = table.column("regular").to_numpy()
            vector[table.column("code").to_numpy()[regular > 0] // width] += regular[regular > 0]
        ids = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(ids * width + identity[ids]), pa.array(vector[ids])], ["code", "n"])

    return summed


def _pairs(width: int, identity: np.ndarray):
    """(block, code, n, same): a block's counts of links in other than regular groups, and whether the identity map holds the pair."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, kinds in each_block(batches, ["block", "kinds"]):
            table = unpack_rows(kinds)
            code, n = table.column("code").to_numpy(), table.column("pairs").to_numpy()
            code, n = code[n > 0], n[n > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), number)), pa.array(code), pa.array(n), pa.array(identity[code // width] == code % width)],
                ["block", "code", "n", "same"])

    return listed


class Counts:
    """Blocks of aligned documents and the corpus-wide counts of their pairs; ``close`` when nothing reads them any more."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = ALIGN_BYTES):
        own = aligner(a_path, b_path)
        self.docs, self.width, self.identity = docs, own.width, own.identity
        self.blocks, self.name = home(
            ids_and_bytes(docs, id_col, text_col), "body", text_bytes(docs, text_col), ["doc_id"], _describe(a_path, b_path),
            ("texts", "chunks", "links", "kinds"), block_bytes)
        kinds = self.blocks.select("block", "kinds")
        self.regular = kinds.mapInArrow(_vectors(self.width, self.identity), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        self.asked = kinds.mapInArrow(_pairs(self.width, self.identity), "block long, code long, n long, same boolean")
        self.pairs = staged(self.asked.groupBy("code", "same").agg(F.sum("n").alias("n")), "token-pairs")

    def vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Totals of A's identity pairs and the highest total of each B id: as long as the vocabularies."""
        total, highest = np.zeros(len(self.identity), np.int64), np.zeros(self.width, np.int64)
        for code, n in chain(self.regular.collect(), self.pairs.where("same").select("code", "n").collect()):
            total[code // self.width] += n
        for b, n in self.pairs.where("not same").groupBy((F.col("code") % self.width).alias("b")).agg(F.max("n")).collect():
            highest[b] = n
        has = self.identity >= 0
        np.maximum.at(highest, self.identity[has], total[has])
        return total, highest

    def table(self) -> DataFrame:
        """a_id, b_id, n: how many links of the corpus hold the pair."""
        counts = self.regular.unionByName(self.pairs.select("code", "n")).groupBy("code").agg(F.sum("n").alias("n"))
        return counts.select(F.expr(f"int(code div {self.width})").alias("a_id"), (F.col("code") % self.width).cast("int").alias("b_id"), "n")

    def told(self) -> DataFrame:
        """The blocks with the totals of their pairs beyond the identity map."""
        totals = self.pairs.where("not same").select("code", F.col("n").alias("total"))
        answers = self.asked.where("not same").select("block", "code").join(totals, "code")
        listed = answers.groupBy("block").agg(F.collect_list(F.struct("code", "total")).alias("answers"))  # at most a block's pairs
        return self.blocks.join(listed, "block", "left")

    def close(self) -> None:
        forget(self.docs, self.name)


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _evaluate(width: int, identity: np.ndarray, total: np.ndarray, highest: np.ndarray):
    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts, chunks, links, kinds = (unpack_rows(batch.column(c)[i].as_py()) for c in ("texts", "chunks", "links", "kinds"))
                code = kinds.column("code").to_numpy()
                a, b = code // width, code % width
                n = np.where(identity[a] == b, total[a], 0)
                told = batch.column("answers")[i].values
                if told is not None and len(told):
                    n[np.searchsorted(code, told.field("code").to_numpy())] = told.field("total").to_numpy()
                kind, at = links.column("kind").to_numpy(), links.column("chunk").to_numpy()
                chunk, ends = chunks.column("chunk").to_numpy(), texts.column("end").to_numpy()
                size = int(at[-1]) + 1 if len(at) else 0
                size = max(size, int(chunk.max()) + 1 if len(chunk) else 0)
                best = np.bincount(at, weights=(n == highest[b])[kind], minlength=size).astype(np.int64)
                summed = np.zeros(size, np.int64)
                np.add.at(summed, at, n[kind])
                upto = lambda values: np.diff(np.concatenate([[0], np.cumsum(values[chunk])])[ends], prepend=0)
                whole = texts.column("whole").to_numpy()
                n_a, n_b, n_groups = (texts.column(c).to_numpy() for c in ("n_a", "n_b", "n_groups"))
                yield pa.RecordBatch.from_arrays(
                    [texts.column("doc_id").combine_chunks(), *map(pa.array, (n_a, n_b, n_groups, n_a + n_b - n_groups)),
                     pa.array(upto(best) * whole), pa.array(upto(summed) * whole), texts.column("groups_sha256").combine_chunks()],
                    [c.split()[0] for c in ALIGNED.split(", ")])

    return evaluated


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = ALIGN_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    counts = Counts(docs, a_path, b_path, id_col, text_col, block_bytes)
    total, highest = counts.vectors()
    result = staged(counts.told().mapInArrow(_evaluate(counts.width, counts.identity, total, highest), ALIGNED), "aligned")
    counts.close()
    return result
