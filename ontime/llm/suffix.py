"""Repeated substrings by a sparse enhanced suffix array and its common-prefix interval tree.

A string of ``LENGTH`` bytes is repeated iff the suffixes at one of its *anchors* agree far enough to both sides. Anchors are
chosen by content: of the ``WINDOW`` grams of ``GRAM`` bytes in such a string, those with the least hash. Equal strings choose
equal anchors, so about one suffix in fifteen has to be sorted and no repeat is lost. The context of an anchor is all that
a string around it can hold: LEFT bytes before and LENGTH bytes from the anchor on.

1. Documents become blocks (see blocks.py). Each asks about its distinct pairs of gram and context, as hashes with the
   smallest document id, bucketed by gram.
2. Buckets answer: a context that a smaller document has too is covered whole; of a gram with several contexts, the
   smallest holders send their bytes; a gram with more contexts than ``CROWD`` is crowded.
3. The suffixes sent are sorted with their common-prefix lengths per bucket of grams (grams stay together). A stack scan yields the
   intervals of the tree; within an interval, sorting by what stands to the left and scanning again tests left-extension
   diversity and yields maximal repeats with all their occurrences. Occurrences in other than the smallest document are spans.
4. What is left of crowded grams, where one group could hold a third of all rows, is decided by the hash of each string
   around the anchor instead: the smallest id per hash is aggregated before it moves, and joined back.
5. Each block unites the spans of its documents.

Defined results: null text counts as empty; a null id is larger than all others; equal ids are one document, so rows that
repeat an id don't remove each other's bytes; an empty table gives an empty result; other columns are kept by
``without_repeats`` and not read by ``repeat_spans``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.blocks import BLOCK_BYTES, bucket_count, buffers, each_block, forget, home, mixed, runs, unpack_rows, with_answers
from ontime.llm.common import named, staged, text_bytes

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
LEFT = LENGTH - GRAM
CROWD = 256
PIECE = 1 << 18
NO_ID = np.iinfo(np.int64).max
GRAM_BITS, CONTEXT_BYTES = 40, 6

_FACTOR = 0x9E3779B97F4A7C15
_BYTES = mixed(np.arange(1, 258, dtype=np.uint64) * np.uint64(_FACTOR))  # value of each byte, and of the gap between documents
_UNIT = 16


def _power(length: int) -> np.uint64:
    return np.uint64(pow(_FACTOR, length, 1 << 64))


def _joined(a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Hash of strings from the hashes of their parts, of which the second has ``length`` values: a polynomial modulo 2^64."""
    out = a * _power(length)
    out += b
    return out


def _units(values: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the strings of 1, 2, 4, 8, 16 values from each position on (along the last axis)."""
    out = {1: _BYTES[values]}
    for size in (1, 2, 4, 8):
        x = out[size]
        out[2 * size] = _joined(x[..., :-size], x[..., size:], size)
    return out


def _spanned(units: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Hash of the ``length`` values from each position on, mixed."""
    out, done = None, 0
    while done < length:
        size = min(_UNIT, 1 << (length - done).bit_length() - 1)
        x = units[size][..., done:]
        out = x.copy() if out is None else _joined(out[..., : x.shape[-1]], x[..., : out.shape[-1]], size)
        done += size
    return mixed(out)


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = of(x[..., :-size], x[..., size:])
        size *= 2
    return of(x[..., : x.shape[-1] - (width - size)], x[..., width - size:]) if size < width else x


class Anchors:
    """Anchors of some texts: text, place, hash of gram and of context."""

    def __init__(self, texts: list[np.ndarray]):
        found = [self._of(texts[a:b], a) for a, b in self._pieces(texts)]
        self.text, self.place, self.gram, self.context = (
            np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64 if i > 1 else np.int64) for i in range(4))

    @staticmethod
    def _pieces(texts: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= PIECE or i + 1 == len(texts):
                yield start, i + 1
                start, size = i + 1, 0

    @staticmethod
    def _of(texts: list[np.ndarray], first: int) -> tuple:
        """Anchors of consecutive texts; a long text is cut into parts that overlap by all a context can reach."""
        parts, starts, text, offset, own = [np.full(LENGTH, 256, np.uint16)], [], [], [], []
        at = LENGTH
        for i, body in enumerate(texts):
            for cut in range(0, max(1, len(body)), PIECE):
                low, high = max(0, cut - LENGTH), min(len(body), cut + PIECE + 2 * LENGTH)
                parts += [body[low:high], parts[0]]
                starts.append(at)
                text.append(first + i)
                offset.append(low)
                own.append((cut - low, min(len(body) - LENGTH, cut + PIECE - 1) - low))  # strings that start in this part
                at += high - low + LENGTH
        values = np.concatenate(parts)
        starts, text, offset = np.array(starts), np.array(text, np.int32), np.array(offset)
        units = _units(values)
        grams = _spanned(units, GRAM)
        change = np.zeros(len(values) + 1, np.int32)
        for start, (low, high) in zip(starts, own):
            if high >= low:
                change[start + low] += 1
                change[start + high + 1] -= 1
        valid = np.cumsum(change[:-1]) > 0
        least = _sliding(grams, WINDOW, np.minimum)
        least = np.where(valid[: len(least)], least, np.uint64(0))
        padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least])
        chosen = np.flatnonzero(_sliding(padded, WINDOW, np.maximum) == grams[: len(least)])
        chosen = chosen[grams[chosen] > 0]
        context = np.zeros(len(chosen), np.uint64)
        for reach in range(-LEFT, LENGTH, _UNIT):  # LEFT + LENGTH is a multiple of the unit
            context = _joined(context, units[_UNIT][chosen + reach], _UNIT)
        context = mixed(context)
        part = np.searchsorted(starts, chosen, "right") - 1
        return text[part], (chosen - starts[part] + offset[part]).astype(np.int64), grams[chosen], context


def _strings(texts: list[np.ndarray], text: np.ndarray, place: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings around some anchors that chose them: number of the anchor, start, hash."""
    values = np.full((len(text), LEFT + LENGTH), 256, np.uint16)
    for i, (t, p) in enumerate(zip(text.tolist(), place.tolist())):
        piece = texts[t][max(0, p - LEFT): p + LENGTH]
        gap = max(0, LEFT - p)
        values[i, gap: gap + len(piece)] = piece
    units = _units(values)
    least = _sliding(_spanned(units, GRAM), WINDOW, np.minimum)
    lengths = np.array([len(texts[t]) for t in text.tolist()], np.int64)
    start = (place - LEFT)[:, None] + np.arange(WINDOW)
    row, offset = np.nonzero((least == gram[:, None]) & (start >= 0) & (start + LENGTH <= lengths[:, None]))
    return row, start[row, offset], _spanned(units, LENGTH)[row, offset]


def _texts(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    ids = rows.column("doc_id").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    keys = np.where(known, ids.fill_null(0).to_numpy(zero_copy_only=False), NO_ID)
    return keys, [np.frombuffer(b.as_buffer(), np.uint8) for b in rows.column("body")]


class Block:
    """The distinct (gram, context) of a block with their smallest document, and all anchors in that order."""

    def __init__(self, rows: bytes, buckets: int, crowd: int):
        self.rows = unpack_rows(rows)
        self.keys, self.texts = _texts(self.rows)
        a = Anchors(self.texts)
        n = len(a.text)
        order = np.argsort(a.context, kind="stable")
        first = runs(a.context[order])
        size = np.diff(np.append(first, n))
        key = self.keys[a.text[order]]
        least = np.minimum.reduceat(key, first) if n else key
        gram = a.gram[order[first]]  # contexts hold their gram
        bucket = gram % np.uint64(buckets)
        gram = gram // np.uint64(buckets) & np.uint64((1 << GRAM_BITS) - 1)
        entries = np.argsort(bucket << np.uint64(GRAM_BITS) | gram, kind="stable")
        bucket, gram = bucket[entries].astype(np.int64), gram[entries]
        start = runs(bucket << GRAM_BITS | gram.astype(np.int64))
        kinds = np.diff(np.append(start, len(entries)))
        crowded = np.repeat(kinds > crowd, kinds)
        # all contexts of a locally crowded gram are asked about as one
        stays = ~crowded
        stays[start] = True
        question = np.empty(len(entries), np.int64)
        question[entries] = np.cumsum(stays) - 1
        self.question, self.least = np.repeat(question, size), np.repeat(least, size)  # of each anchor, by context
        self.text, self.place, self.gram, self.key = a.text[order], a.place[order], a.gram[order], key
        asked = entries[stays]
        self.bucket, self.short, self.crowded = bucket[stays], gram[stays], crowded[stays]
        self.context, self.asked_key = a.context[order[first[asked]]] if n else a.context, least[asked]


def _ask(buckets: int, crowd: int):
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in each_block(batches, ["block", "rows"]):
            own = Block(rows, buckets, crowd)
            start = runs(own.bucket)
            columns = {name: [] for name in ("gram", "context", "key", "crowded")}
            for part in np.split(np.arange(len(own.bucket)), start[1:]) if len(start) else []:
                step = np.diff(own.short[part], prepend=np.uint64(0))
                width = 4 if int(step.max()) < 1 << 32 else 8
                columns["gram"].append(bytes([width]) + step.astype(f"<u{width}").tobytes())
                columns["context"].append(np.ascontiguousarray(own.context[part].view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BYTES]).tobytes())
                columns["key"].append(own.asked_key[part].tobytes())
                columns["crowded"].append(np.packbits(own.crowded[part]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(start), pa.int64()), pa.array(own.bucket[start], pa.int32()),
                 *[pa.array(c, pa.binary()) for c in columns.values()]], ["block", "bucket", *columns])

    return asked


COVERED, SENDS, CROWDED = 1, 2, 4


def _answer(crowd: int):
    """For each entry whether it is covered by a smaller document, has to send its bytes, or belongs to a crowded gram."""

    def answered(table: pa.Table) -> pa.Table:
        grams, contexts, keys, crowds = [], [], [], []
        for gram, context, key, crowded in zip(*(buffers(table.column(c)) for c in ("gram", "context", "key", "crowded"))):
            grams.append(np.cumsum(np.frombuffer(gram, f"<u{gram[0]}", offset=1), dtype=np.uint64))
            wide = np.zeros((len(grams[-1]), 8), np.uint8)
            wide[:, :CONTEXT_BYTES] = np.frombuffer(context, np.uint8).reshape(-1, CONTEXT_BYTES)
            contexts.append(wide.view("<u8").ravel())
            keys.append(np.frombuffer(key, np.int64))
            crowds.append(np.unpackbits(np.frombuffer(crowded, np.uint8), count=len(grams[-1])).astype(bool))
        cuts = np.cumsum([len(g) for g in grams])[:-1]
        gram, context, key, crowded = map(np.concatenate, (grams, contexts, keys, crowds))
        del grams, contexts, keys, crowds
        order = np.lexsort((context, gram))
        gram, context, key, crowded = gram[order], context[order], key[order], crowded[order]
        g_start = runs(gram)
        g_size = np.diff(np.append(g_start, len(gram)))
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        del gram, context
        least = np.minimum.reduceat(key, np.flatnonzero(new))[np.cumsum(new) - 1]
        kinds = np.add.reduceat(new.astype(np.int64), g_start)
        several = (kinds > 1) & (np.minimum.reduceat(key, g_start) < np.maximum.reduceat(key, g_start))
        many = (kinds > crowd) | np.logical_or.reduceat(crowded, g_start)
        many, several = np.repeat(many, g_size), np.repeat(several, g_size)
        status = np.where(crowded, CROWDED, np.where(key > least, COVERED, np.where(many, CROWDED, np.where(several, SENDS, 0))))
        out = np.empty(len(order), np.uint8)
        out[order] = status
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "status": pa.array([x.tobytes() for x in np.split(out, cuts)], pa.binary())})

    return answered


FOUND = "block long, spans binary, text int, at long, gram long, id long, before binary, onward binary, string long"


def _found(block: int, **columns) -> pa.RecordBatch:
    """Rows of FOUND with nulls in all columns that aren't given."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    arrays, names = [], []
    for column in FOUND.split(", "):
        name, kind = column.split()
        names.append(name)
        given = [block] * n if name == "block" else columns.get(name)
        arrays.append(pa.nulls(n, kinds[kind]) if given is None else pa.array(given, kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names)


def _gather(buckets: int, crowd: int):
    """What each block's answers lead to: its packed spans, suffixes (gram, before, onward), or strings of crowded grams."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, answers in each_block(batches, ["block", "rows", "answers"]):
            if not answers:
                continue
            own = Block(rows, buckets, crowd)
            status = np.concatenate([np.frombuffer(a["status"], np.uint8) for a in answers])[own.question]
            lengths = np.array([len(t) for t in own.texts])
            whole = (status == COVERED) | (own.key > own.least)
            low = np.maximum(own.place[whole] - LEFT, 0)
            high = np.minimum(own.place[whole] + LENGTH, lengths[own.text[whole]])
            enough = high - low >= LENGTH
            yield _found(number, spans=[_packed(own.text[whole][enough], low[enough], high[enough])])
            sends = np.flatnonzero((status == SENDS) & (own.key == own.least))
            bodies = {t: own.texts[t].tobytes() for t in np.unique(own.text[sends]).tolist()}
            where = list(zip(own.text[sends].tolist(), own.place[sends].tolist()))
            yield _found(number, text=own.text[sends], at=own.place[sends], gram=own.gram[sends].view(np.int64), id=own.key[sends],
                         before=[bodies[t][max(0, p - LEFT):p] for t, p in where], onward=[bodies[t][p:p + LENGTH] for t, p in where])
            crowded = np.flatnonzero((status == CROWDED) & (own.key == own.least))
            for i in np.array_split(crowded, 1 + len(crowded) // 4096):
                row, start, string = _strings(own.texts, own.text[i], own.place[i], own.gram[i])
                yield _found(number, text=own.text[i][row], at=start, id=own.key[i][row], string=string.view(np.int64))

    return gathered


def _united(text: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and adjoining spans of a text as one."""
    order = np.lexsort((low, text))
    text, low, high = text[order], low[order], high[order]
    if not len(text):
        return text, low, high
    # ends grow within a text once each is the running maximum; texts are kept apart by a large shift
    shift = text.astype(np.int64) * (int(high.max()) + 2)
    reach = np.maximum.accumulate(high + shift)
    start = np.concatenate([[True], (low + shift)[1:] > reach[:-1]])
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(text)) - 1
    return text[first], low[first], reach[last] - shift[first]


def _packed(text: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    return np.concatenate([x.astype(np.int64) for x in _united(text, low, high)]).tobytes()


def _packed_by_block(block: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    order = np.argsort(block, kind="stable")
    cuts = np.split(order, runs(block[order])[1:]) if len(order) else []
    return [pa.array([block[i[0]] for i in cuts], pa.int64()), pa.array([_packed(text[i], low[i], high[i]) for i in cuts], pa.binary())]


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """The tree of common-prefix intervals as (length, first, last); ``common[i]`` belongs to entries i - 1 and i."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        length = common[i] if i < len(common) else 0
        first = i - 1
        while stack and stack[-1][0] > length:
            own, first = stack.pop()
            yield own, first, i - 1
        if length and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings])
    flat = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    return flat, sizes


def _agreement(rows: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a[i] and b[i]."""
    differs = rows[a] != rows[b]
    n = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.minimum(n, np.minimum(sizes[a], sizes[b]))


def _sorted_rows(rows: np.ndarray, sizes: np.ndarray, *before: np.ndarray) -> np.ndarray:
    """Order by ``before``, then bytes, then length."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words = padded.view(">u8").astype(np.uint64)
    return np.lexsort((sizes, *words.T[::-1], *before[::-1]))


def maximal_repeats(gram: np.ndarray, before: list[bytes], onward: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Maximal repeats of at least LENGTH bytes among suffixes with their left context: (left, right, occurrences).

    The occurrences agree in exactly ``left`` bytes before and ``right`` bytes from the suffix's start on.
    """
    right, right_size = _matrix(onward, LENGTH)
    left, left_size = _matrix([b[::-1] for b in before], LEFT)
    order = _sorted_rows(right, right_size, gram)
    a, b = order[:-1], order[1:]
    common = np.append(0, np.where(gram[a] == gram[b], _agreement(right, right_size, a, b), 0))
    beside = np.append(0, _agreement(left, left_size, a, b))
    for length, first, last in intervals(common.tolist()):
        if last == first + 1:
            if beside[last] + length >= LENGTH:
                yield int(beside[last]), length, order[first: last + 1]
            continue
        inside = np.arange(first, last + 1)
        own = order[inside]
        by_left = _sorted_rows(left[own], left_size[own])
        own, at = own[by_left], inside[by_left]
        agree = np.append(0, _agreement(left, left_size, own[:-1], own[1:]))
        agree = np.where(agree + length >= LENGTH, agree, -1) + 1  # shorter ones part the groups
        agree[0] = 0
        for more, low, high in intervals(agree.tolist()):
            lowest, highest = at[low: high + 1].min(), at[low: high + 1].max()
            if common[lowest + 1: highest + 1].min() == length:  # else all of them agree further to the right
                yield more - 1, length, own[low: high + 1]


def _repeats(table: pa.Table) -> pa.Table:
    """Spans of the suffixes of one bucket that lie in a repeat with a smaller document, packed by block."""
    gram, key, at, text, block = (table.column(c).to_numpy() for c in ("gram", "id", "at", "text", "block"))
    spans = [np.zeros((0, 4), np.int64)]
    for left, right, own in maximal_repeats(gram, table.column("before").to_pylist(), table.column("onward").to_pylist()):
        own = own[key[own] > key[own].min()]
        spans.append(np.column_stack([block[own], text[own], at[own] - left, at[own] + right]))
    return pa.table(_packed_by_block(*np.concatenate(spans).T), ["block", "spans"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block and batch with its spans united."""
    for batch in batches:
        block, text, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "text", "at"))
        yield pa.RecordBatch.from_arrays(_packed_by_block(block, text, at, at + LENGTH), ["block", "spans"])


def _blocks_with_spans(blocks: DataFrame, buckets: int, crowd: int) -> DataFrame:
    """Each block with its packed spans as a list of ``answers``."""
    asked = blocks.select("block", "rows").mapInArrow(
        _ask(buckets, crowd), "block long, bucket int, gram binary, context binary, key binary, crowded binary")
    answers = staged(asked.groupBy("bucket").applyInArrow(_answer(crowd), "block long, bucket int, status binary"), "repeat-answers")
    told = with_answers(blocks.select("block", "rows"), answers, ["bucket", "status"])
    found = staged(told.mapInArrow(_gather(buckets, crowd), FOUND), "repeat-found")
    sent = found.where("gram is not null").select("block", "text", "at", "gram", "id", "before", "onward")
    sent = sent.withColumn("bucket", F.pmod("gram", F.lit(buckets).cast("long")))
    strings = found.where("string is not null").select("block", "text", "at", "id", "string")
    least = strings.groupBy("string").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    crowded = strings.join(least, "string").where("id > least").select("block", "text", "at")
    packed = (
        found.where("spans is not null").select("block", "spans")
        .unionByName(sent.groupBy("bucket").applyInArrow(_repeats, "block long, spans binary"))
        .unionByName(crowded.mapInArrow(_pack, "block long, spans binary"))
    )
    return with_answers(blocks, packed, ["spans"])


def _removed(texts: int, answers: list | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the united spans of each text."""
    parts = [np.frombuffer(a["spans"], np.int64).reshape(3, -1) for a in answers or []]
    text, low, high = _united(*np.concatenate([np.zeros((3, 0), np.int64), *parts], axis=1))
    cut = np.searchsorted(text, np.arange(texts + 1))
    return [(low[a:b], high[a:b]) for a, b in zip(cut, cut[1:])]


def _kept(body: bytes, low: np.ndarray, high: np.ndarray) -> bytes:
    return b"".join(body[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(body)]))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""

    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, answers in each_block(batches, ["rows", "answers"]):
            own = unpack_rows(rows)
            bodies = own.column("body").to_pylist()
            spans = _removed(len(bodies), answers)
            yield pa.RecordBatch.from_arrays(
                [own.column("doc_id").combine_chunks(), pa.array([len(b) for b in bodies], pa.int64()),
                 pa.array([int((high - low).sum()) for low, high in spans], pa.int64()), pa.array([len(low) for low, _ in spans], pa.int64()),
                 pa.array([hashlib.sha256(_kept(b, *s)).hexdigest() for b, s in zip(bodies, spans)], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    total = text_bytes(docs, text_col)
    blocks, name = home(rows, "body", total, ["doc_id", "body"], limit=block_bytes)
    told = _blocks_with_spans(blocks, bucket_count(total), crowd)
    result = staged(told.mapInArrow(reported, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "repeat-report")
    forget(docs, name)
    return result


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows of ``docs``, their texts without the removed bytes; characters that lost some of their bytes go whole."""
    others = [c for c in docs.columns if c != text_col]
    alias = {c: f"c{i}" for i, c in enumerate(others)}
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
        *[named(c).alias(a) for c, a in alias.items()])
    total = text_bytes(docs, text_col)
    blocks, _ = home(rows, "body", total, rows.columns, limit=block_bytes)
    told = _blocks_with_spans(blocks, bucket_count(total), crowd)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, answers in each_block(batches, ["rows", "answers"]):
            own = unpack_rows(rows)
            bodies = own.column("body").to_pylist()
            texts = [_kept(b, *s).decode("utf-8", "ignore") for b, s in zip(bodies, _removed(len(bodies), answers))]
            done = own.select(list(alias.values())).append_column("body", pa.array(texts, pa.string()))
            yield from done.combine_chunks().to_batches()

    schema = T.StructType([*[T.StructField(alias[c], docs.schema[c].dataType) for c in others], T.StructField("body", T.StringType())])
    return told.mapInArrow(cleaned, schema).select([F.col(alias.get(c, "body")).alias(c) for c in docs.columns])
