"""Katz backoff language model with Good-Turing discounts, trained and evaluated on the same corpus.

Tokens are words and one end per text. With counts of the training texts only,

    P(w | h) = d(r) * r / c(h)      if the pair (h, w) was seen r > 0 times,
               a(h) * P(w)          if not, where h was seen,
               P(w)                 if h was never seen;
    P(w)     = d1(c) * c / N        if w was seen c > 0 times, else all that the seen words leave, for any unknown word.

d and d1 are Katz's discounts from the counts of counts up to ``TRUSTED``; larger counts give up the constant
``LEFT_OVER`` of a count, so every history leaves something. a(h) is what h leaves divided by what P leaves for words not
seen after h, both as sums over the pairs themselves, so each distribution sums to one.

1. Documents become blocks (see blocks.py): the block's distinct words as 64-bit hashes and its texts as numbers of them.
2. Each block asks about its distinct pairs, bucketed by history, with its own training counts. A bucket answers with
   the total of every pair, of every history, and with one block named owner of the pair. Histories with 1/4096 of all
   tokens are bucketed by pair instead, and their totals, 4096 numbers at most, are counted apart. Each bucket adds its
   part of the counts of counts, which are summed up to a few numbers.
3. The owners of pairs add up what each history leaves; the sums by history make the table of backoff weights.
4. Each block evaluates its texts; tokens that back off are joined with the weights by history and summed up by text.

Defined results: null text counts as empty and has one token, the end; a null id counts as the empty text in the held-out
rule; repeated rows are trained on and scored one by one; without any training text all tokens are unknown with
probability one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.blocks import BLOCK_BYTES, ROW_BITS, bucket_count, buffers, each_block, forget, home, mixed, runs, unpack_rows, with_answers
from ontime.llm.common import LOWER, crc_mod, named, staged, text_bytes

TRUSTED = 5
LEFT_OVER = 0.1
#: A history with this share of all tokens is dealt out by pair.
HOT_SHARE = 4096
START, END = np.uint64(1), np.uint64(2)
WORD_BYTES = 6


class Numbered(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def describe(block: pa.Table) -> dict[str, bytes]:
    """Distinct words of a block as hashes, its texts as numbers of words, and the words of each text."""
    number = Numbered()
    texts, counts = [], []
    for body in block.column("body"):
        words = body.as_buffer().to_pybytes().translate(LOWER).split()
        counts.append(len(words))
        texts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
    stream = np.concatenate([np.zeros(0, np.int32), *texts])
    order = np.argsort(-np.bincount(stream, minlength=len(number)), kind="stable")  # frequent words get small numbers
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    planes = place[stream].astype("<u4").view(np.uint8).reshape(-1, 4).T  # byte by byte, which packs better
    return {"words": hashes[order].tobytes(), "stream": planes.tobytes(), "counts": np.array(counts, np.int64).tobytes()}


class Block:
    """The token pairs of a block. Words have numbers below ``v``, then come start and end."""

    def __init__(self, rows: bytes, words: bytes, stream: bytes, counts: bytes):
        self.rows = unpack_rows(rows)
        self.held = self.rows.column("held").to_numpy()
        self.n_words = np.frombuffer(counts, np.int64)
        self.hashes = np.concatenate([np.frombuffer(words, np.uint64), [START, END]])
        self.v = len(self.hashes) - 2
        texts = np.frombuffer(stream, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
        self.stream = texts
        self.text = np.repeat(np.arange(len(self.n_words), dtype=np.int32), self.n_words + 1)  # of each token
        ends = np.cumsum(self.n_words + 1) - 1
        is_end = np.zeros(len(self.text), bool)
        is_end[ends] = True
        self.token = np.full(len(self.text), self.v + 1, np.int32)
        self.token[~is_end] = texts
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[ends - self.n_words] = self.v
        self.before = before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs as history, word, and the number of the pair of each token."""
        flat, number = np.unique(self.before.astype(np.int64) * (self.v + 2) + self.token, return_inverse=True)
        return flat // (self.v + 2), flat % (self.v + 2), number

    def train_counts(self) -> np.ndarray:
        """Occurrences of each word in the training texts."""
        trained = np.repeat(~self.held, self.n_words)
        return np.bincount(self.stream[trained], minlength=self.v)

    def order(self, h: np.ndarray, w: np.ndarray, buckets: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each pair, and the pairs in order of their buckets, histories together."""
        is_hot = np.isin(self.hashes, hot)
        is_hot[self.v] = True  # the start
        key = mixed(self.hashes.copy())
        own = np.where(is_hot[h], mixed(key[h] + self.hashes[w]), key[h])
        bucket = (own % np.uint64(buckets)).astype(np.int64)
        return bucket, np.argsort(bucket, kind="stable")


def _truncated(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()


def _widened(data: pa.Buffer) -> np.ndarray:
    packed = np.frombuffer(data, np.uint8).reshape(-1, WORD_BYTES)
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, :WORD_BYTES] = packed
    return out.view("<u8").ravel()


def _ask(buckets: int, hot: np.ndarray):
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, *packed in each_block(batches, ["block", "rows", "words", "stream", "counts"]):
            own = Block(*packed)
            h, w, pair = own.pairs()
            count = np.bincount(pair, weights=~own.held[own.text], minlength=len(h)).astype(np.uint32)
            bucket, order = own.order(h, w, buckets, hot)
            first = runs(bucket[order])
            cut = np.split(order, first[1:])
            columns = {name: [] for name in ("bucket", "h", "run", "w", "n")}
            for part in cut:
                start = runs(h[part])
                columns["bucket"].append(int(bucket[part[0]]))
                columns["h"].append(own.hashes[h[part[start]]].tobytes())
                columns["run"].append(np.diff(np.append(start, len(part))).astype(np.uint32).tobytes())
                columns["w"].append(_truncated(own.hashes[w[part]]))
                columns["n"].append(count[part].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(cut), pa.int64()), pa.array(columns["bucket"], pa.int32()),
                 *[pa.array(columns[c], pa.binary()) for c in ("h", "run", "w", "n")]], ["block", "bucket", "h", "run", "w", "n"])

    return asked


def _answer(hot: np.ndarray):
    """Totals of pairs and histories, one owner per seen pair, and the bucket's part of the counts of counts."""

    def answered(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")  # owners must not depend on the order of arrival
        heads = [np.frombuffer(x, np.uint64) for x in buffers(table.column("h"))]
        lengths = [np.frombuffer(x, np.uint32) for x in buffers(table.column("run"))]
        h = np.concatenate([np.repeat(x, run) for x, run in zip(heads, lengths)])
        w = np.concatenate([_widened(x) for x in buffers(table.column("w"))])
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in buffers(table.column("n"))])
        pair_cuts = np.cumsum([run.sum(dtype=np.int64) for run in lengths])[:-1]
        order = np.lexsort((w, h))
        hs, ws, n = h[order], w[order], n[order].astype(np.int64)
        del h, w
        start = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (ws[1:] != ws[:-1])]))
        del ws
        total = np.add.reduceat(n, start)
        size = np.diff(np.append(start, len(order)))
        r = np.empty(len(order), np.int64)
        r[order] = np.repeat(total, size)
        owner = np.zeros(len(order), bool)
        owner[order[start]] = total > 0  # lexsort is stable: the first asker
        h_start = runs(hs)
        h_total = np.add.reduceat(n, h_start)
        c = h_total[np.searchsorted(hs[h_start], np.concatenate(heads))]
        cold = ~np.isin(hs[h_start], np.concatenate([hot, [START]]))
        words = h_total[cold & (h_total > 0)]
        tally = [*(int((total == i).sum()) for i in range(1, TRUSTED + 2)), *(int((words == i).sum()) for i in range(1, TRUSTED + 2)),
                 int(len(words)), int(words.sum())]
        h_cuts = np.cumsum([len(x) for x in heads])[:-1]
        flagged = (r << 1 | owner).astype(np.uint64)
        number, bucket = table.column("block").to_pylist(), table.column("bucket").to_pylist()
        return pa.table({
            "block": pa.array([*number, -1], pa.int64()), "bucket": pa.array([*bucket, bucket[0]], pa.int32()),
            "r": pa.array([*(_narrow(x) for x in np.split(flagged, pair_cuts)), None], pa.binary()),
            "c": pa.array([*(_narrow(x) for x in np.split(c.astype(np.uint64), h_cuts)), None], pa.binary()),
            "tally": pa.array([None] * len(number) + [tally], pa.list_(pa.int64())),
        })

    return answered


def _narrow(x: np.ndarray) -> bytes:
    """The values with the fewest bytes each that hold them all, told by a first byte."""
    width = next(b for b in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * b)
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def katz_discounts(counts_of_counts: list[int]) -> np.ndarray:
    """What of a count r is kept, for r = 0..TRUSTED; a count of counts that Katz's formula can't use keeps r - LEFT_OVER."""
    n = [0, *counts_of_counts]
    kept = np.maximum(np.arange(TRUSTED + 1) - LEFT_OVER, 0.0)
    common = (TRUSTED + 1) * n[TRUSTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, TRUSTED + 1):
        if n[r] and n[r + 1] and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            if 0 < d < 1:
                kept[r] = d * r
    return kept


class Model:
    """The few numbers of the model that every block needs."""

    def __init__(self, tally: list[int], hot: np.ndarray, hot_counts: np.ndarray, train_texts: int):
        pairs, words, (distinct, total) = tally[:TRUSTED + 1], list(tally[TRUSTED + 1: 2 * TRUSTED + 2]), tally[-2:]
        for c in [*hot_counts, train_texts]:  # the end is a word like others, seen once per training text
            if 1 <= c <= TRUSTED + 1:
                words[int(c) - 1] += 1
        self.hot, self.hot_counts = hot, hot_counts
        self.train_texts = train_texts
        self.n = int(total + hot_counts.sum() + train_texts)
        self.v = int(distinct + (hot_counts > 0).sum() + (train_texts > 0))
        self.kept2, self.kept1 = katz_discounts(pairs), katz_discounts(words)
        # what words of each count leave; the large ones leave LEFT_OVER each
        small = sum(k * (i + 1 - self.kept1[i + 1]) for i, k in enumerate(words[:TRUSTED]))
        self.unknown = (small + LEFT_OVER * (self.v - sum(words[:TRUSTED]))) / self.n if self.n else 1.0

    @staticmethod
    def kept(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.where(counts <= TRUSTED, table[np.minimum(counts, TRUSTED)], counts - LEFT_OVER)

    def word_logs(self, counts: np.ndarray) -> np.ndarray:
        """Natural logarithm of P of words with these counts."""
        p = np.where(counts > 0, self.kept(counts, self.kept1) / max(self.n, 1), self.unknown)
        return np.log(p)


def _answered(own: Block, answers: list, buckets: int, model: Model) -> tuple:
    """Pairs of a block with their totals and owners, and the count of every word, start and end."""
    h, w, pair = own.pairs()
    bucket, order = own.order(h, w, buckets, model.hot)
    flagged = np.empty(len(h), np.int64)
    flagged[order] = np.concatenate([_wide(a["r"]) for a in answers])
    counts = np.zeros(own.v + 2, np.int64)
    for part, a in zip(np.split(order, runs(bucket[order])[1:]), answers):
        counts[h[part[runs(h[part])]]] = _wide(a["c"])
    if len(model.hot):
        known = np.searchsorted(model.hot, own.hashes)
        known[known == len(model.hot)] = 0
        is_hot = model.hot[known] == own.hashes
        counts[is_hot] = model.hot_counts[known[is_hot]]
    counts[own.v:] = model.train_texts
    return h, w, pair, flagged >> 1, (flagged & 1).astype(bool), counts


BLOCK_COLUMNS = ["block", "rows", "words", "stream", "counts", "answers"]


def _leave(buckets: int, model: Model):
    """(h, c, left, taken): what the block's own pairs leave of their histories, and the P of their words."""

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, *packed, answers in each_block(batches, BLOCK_COLUMNS):
            own = Block(*packed)
            h, w, _, r, owned, counts = _answered(own, answers, buckets, model)
            h, w, r = h[owned], w[owned], r[owned]
            start = runs(h)
            if len(start):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.hashes[h[start]].view(np.int64)), pa.array(counts[h[start]]),
                     pa.array(np.add.reduceat(r - model.kept(r, model.kept2), start)),
                     pa.array(np.add.reduceat(np.exp(model.word_logs(counts[w])), start))], ["h", "c", "left", "taken"])

    return left


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, h long, times long"


def _evaluate(buckets: int, model: Model):
    """One row per text with all but its backoff weights, and one per text and history that needs a weight."""

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_token = math.log10(model.n + model.v + 1)
        for number, *packed, answers in each_block(batches, BLOCK_COLUMNS):
            own = Block(*packed)
            h, w, pair, r, _, counts = _answered(own, answers, buckets, model)
            seen, known_h = r > 0, counts[h] > 0
            log_p = np.where(seen, np.log(np.maximum(model.kept(r, model.kept2), 1e-300)) - np.log(np.maximum(counts[h], 1)),
                             model.word_logs(counts[w]))
            texts = len(own.n_words)
            add = lambda values: np.bincount(own.text, weights=values, minlength=texts)  # noqa: B023, E731
            c = counts[own.token]
            n_tokens = own.n_words + 1
            row = np.int64(number) << ROW_BITS | np.arange(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), own.rows.column("doc_id").combine_chunks(), pa.array(own.held), pa.array(n_tokens),
                 pa.array(add(c > 0).astype(np.int64)), pa.array(add(np.log10(c + 1.0)) - n_tokens * per_token),
                 pa.array(add(log_p[pair]) / math.log(10)), pa.array(mixed(row.view(np.uint64).copy()).view(np.int64)),
                 pa.array(np.zeros(texts, np.int64))], [c.split()[0] for c in SCORED.split(", ")])
            backs_off = (~seen & known_h)[pair]
            flat, times = np.unique(own.text[backs_off].astype(np.int64) * (own.v + 2) + own.before[backs_off], return_counts=True)
            if len(flat):
                none = pa.nulls(len(flat), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[flat // (own.v + 2)]), none, pa.nulls(len(flat), pa.bool_()), none, none, pa.nulls(len(flat), pa.float64()),
                     pa.nulls(len(flat), pa.float64()), pa.array(own.hashes[flat % (own.v + 2)].view(np.int64)), pa.array(times.astype(np.int64))],
                    [c.split()[0] for c in SCORED.split(", ")])

    return evaluated


def _hot_words(blocks: DataFrame, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that make up 1/HOT_SHARE of all training tokens, sorted by hash, with their exact counts.

    Candidates are frequent in some block, and their sums over such blocks must reach the share: at most HOT_SHARE do, and
    every word with twice the share is among them.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, *packed in each_block(batches, ["block", "rows", "words", "stream", "counts"]):
            own = Block(*packed)
            n = own.train_counts()
            top = np.flatnonzero((n > 0) & (n * HOT_SHARE >= n.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(own.hashes[top].view(np.int64)), pa.array(n[top])], ["h", "n"])

    found = blocks.mapInArrow(frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") * HOT_SHARE >= tokens).select("h").collect()
    hot = np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, *packed in each_block(batches, ["block", "rows", "words", "stream", "counts"]):
            own = Block(*packed)
            mine = np.flatnonzero(np.isin(own.hashes[: own.v], hot))
            yield pa.RecordBatch.from_arrays([pa.array(own.hashes[mine].view(np.int64)), pa.array(own.train_counts()[mine])], ["h", "n"])

    totals = {r.h: r.n for r in blocks.mapInArrow(exact, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).collect()} if len(hot) else {}
    return hot, np.array([totals[h] for h in hot.view(np.int64).tolist()], np.int64)


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (logarithms to base 10)."""
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
        held_out.alias("held"),
    )
    total = text_bytes(docs, text_col)
    buckets = bucket_count(total)
    blocks, name = home(rows, "body", total, ["doc_id", "held"], describe, ("words", "stream", "counts"), block_bytes)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, packed, counts in each_block(batches, ["block", "rows", "counts"]):
            trained = ~unpack_rows(packed).column("held").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(np.frombuffer(counts, np.int64)[trained].sum())]), pa.array([int(trained.sum())])], ["words", "texts"])

    words, texts = blocks.mapInArrow(sizes, "words long, texts long").agg(
        F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("texts"), F.lit(0))).first()
    hot, hot_counts = _hot_words(blocks, words + texts)
    asked = blocks.mapInArrow(_ask(buckets, hot), "block long, bucket int, h binary, run binary, w binary, n binary")
    answers = staged(asked.groupBy("bucket").applyInArrow(
        _answer(hot), "block long, bucket int, r binary, c binary, tally array<long>"), "lm-answers")
    parts = answers.where("block = -1").select(F.posexplode("tally").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect()
    model = Model([r.n for r in parts] or [0] * (2 * TRUSTED + 4), hot, hot_counts, texts)
    told = with_answers(blocks, answers.where("block >= 0"), ["bucket", "r", "c"])
    left = told.mapInArrow(_leave(buckets, model), "h long, c long, left double, taken double")
    weights = left.groupBy("h").agg(F.max("c").alias("c"), F.sum("left").alias("left"), F.sum("taken").alias("taken")).select(
        "h", (F.log10(F.col("left") / F.col("c")) - F.log10(1 - F.col("taken"))).alias("weight"))
    scored = told.mapInArrow(_evaluate(buckets, model), SCORED).join(weights, "h", "left")
    result = scored.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), F.max("base").alias("base_score"),
        (F.max("score") + F.sum(F.when(F.col("times") > 0, F.col("times") * F.col("weight")).otherwise(0.0))).alias("score"),
    ).drop("row")
    result = staged(result, "lm-scores")
    forget(docs, name)
    return result


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """Scores with the texts held out whose id's crc32 leaves ``held`` modulo ``modulus``."""
    return katz_scores(docs, crc_mod(named(id_col), modulus) == held, id_col, text_col)
