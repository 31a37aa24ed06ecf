"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

1. Fit sample: up to ``sample`` labelled documents in the order of a hash of their ids, the only bounded part. Labels
   decide nothing but the target of the fit.
2. Random indexing: every token has a sparse random index vector made from its hash; a token's context vector is the sum of
   the index vectors of its neighbours. The sums are whole numbers, added up in tasks and by Spark, for the ``vocabulary`` most
   frequent tokens; all other tokens share one vector.
3. A document is the mean of its tokens' vectors with three numbers that say how long and how varied it is.
4. A network with one hidden layer is fitted by Adam on the driver, with a tenth of the sample kept aside to stop and to
   choose the temperature that calibrates the probabilities.
5. The model (its size is bounded by ``vocabulary``) is broadcast, and all documents are scored in one pass without a shuffle.

Defined results: null text counts as empty, and an empty text has the zero vector and is scored like any other; a null id is
never learned from; an id with several labels counts with the smallest; null labels are ignored; repeated rows get equal scores;
without labels of both kinds every score is the share of label 1 (one half without any); an empty table gives an empty
result; other columns are neither read nor changed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import crc_mod, ids_and_bytes, named, staged

SAMPLE = 20_000
VOCABULARY = 30_000
DIMENSIONS = 64
NONZERO = 8
REACH = 2
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3
SLICES = 16
TOKENS_AT_ONCE = 4096
ROWS_AT_ONCE = 512

#: Runs of letters (all bytes beyond ASCII count as letters), runs of digits, single other characters.
TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]")
UPPER = re.compile(rb"[A-Z][A-Z]+")
SHOUT = b"<upper>"


def tokens(body: bytes) -> list[bytes]:
    """Tokens in lower case; an upper-case word also leaves a mark, so shouting shows."""
    return TOKEN.findall(UPPER.sub(rb" \g<0> < ", body).lower())


def bodies(column: pa.Array) -> Iterator[bytes]:
    """The values one by one, null as empty."""
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def index_vector(token: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the sparse random vector of a token."""
    state = np.random.default_rng(xxhash.xxh64_intdigest(token, 7))
    return state.choice(DIMENSIONS, NONZERO, replace=False), state.choice((-1, 1), NONZERO)


def index_matrix(vocabulary: list[bytes]) -> np.ndarray:
    """Index vectors by number; number 0 stands for all tokens that have none of their own."""
    out = np.zeros((len(vocabulary) + 1, DIMENSIONS), np.int32)
    for i, token in enumerate([b"", *vocabulary]):
        places, signs = index_vector(token)
        out[i, places] = signs
    return out


def _context_sums(numbers: dict[bytes, int], index: np.ndarray):
    """Counts of tokens and sums of their neighbours' index vectors, a few thousand tokens at a time."""
    none = len(index)  # stands between documents and has the zero vector
    padded = np.vstack([index, np.zeros((1, DIMENSIONS), index.dtype)])
    gap = [none] * REACH

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(index.shape, np.int64)
        count = np.zeros(len(index), np.int64)

        def add(row: np.ndarray) -> None:
            for at in range(REACH, len(row) - REACH, TOKENS_AT_ONCE):
                own = row[at: min(at + TOKENS_AT_ONCE, len(row) - REACH)]
                around = sum(padded[row[at + step: at + step + len(own)]] for step in range(-REACH, REACH + 1) if step)
                order = np.argsort(own, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1]]))
                words = own[order[first]]
                held = words < none
                count[words[held]] += np.diff(np.append(first, len(own)))[held]
                sums[words[held]] += np.add.reduceat(around[order], first, dtype=np.int64)[held]

        for batch in batches:
            row = list(gap)
            for body in bodies(batch.column("body")):
                row += [numbers.get(t, 0) for t in tokens(body)] + gap
                if len(row) > TOKENS_AT_ONCE:
                    add(np.array(row, np.int64))
                    row = list(gap)
            add(np.array(row, np.int64))
        parts = np.array_split(np.arange(len(index)), SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([np.column_stack([count[p], sums[p]]).tobytes() for p in parts], pa.binary())],
            ["slice", "sums"])

    return summed


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64).copy() for x in table.column("sums").to_pylist())
    return pa.table({"slice": table.column("slice").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def word_vectors(sample: DataFrame, vocabulary: int, tasks: int = 8) -> tuple[dict[bytes, int], np.ndarray]:
    """Numbers of the known tokens and the matrix of their vectors, learned from a bounded table (doc_id, body)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for body in bodies(batch.column("body")):
                seen.update(tokens(body))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    top = sample.mapInArrow(counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(vocabulary)
    known = [bytes(r.token) for r in top.collect()]
    numbers = {t: i + 1 for i, t in enumerate(known)}
    index = index_matrix(known)
    sums = sample.repartition(tasks).mapInArrow(_context_sums(numbers, index), "slice int, sums binary")
    parts = sums.groupBy("slice").applyInArrow(_added, "slice int, sums binary").orderBy("slice").collect()
    whole = np.concatenate([np.frombuffer(r.sums, np.int64).reshape(-1, DIMENSIONS + 1) for r in parts])
    count, context = whole[:, 0].astype(float), whole[:, 1:].astype(float)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    context = unit(context)
    context -= np.average(context, axis=0, weights=count + 1e-9)  # what all contexts have in common tells nothing
    return numbers, (unit(context) + unit(index.astype(float))).astype(np.float32)


def features(body: bytes, numbers: dict[bytes, int], vectors: np.ndarray) -> np.ndarray:
    own = tokens(body)
    if not own:
        return np.zeros(DIMENSIONS + 3, np.float32)
    found = np.array([numbers.get(t, 0) for t in own])
    shape = [np.log1p(len(own)), len(set(own)) / len(own), len(body) / len(own)]
    return np.concatenate([vectors[found].mean(axis=0), shape]).astype(np.float32)


class Network:
    """Two layers, standardised inputs, and a temperature that divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        rng = np.random.default_rng(seed)
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)
        self.temperature = 1.0
        aside = np.arange(len(y)) % 10 == 0
        self._fit(self._standard(x), y.astype(float), aside if 0 < y[aside].mean() < 1 else np.zeros(len(y), bool), rng)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def _fit(self, x: np.ndarray, y: np.ndarray, aside: np.ndarray, rng: np.random.Generator) -> None:
        names = ("w1", "b1", "w2", "b2")
        moment = {n: [np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))] for n in names}
        learn = np.flatnonzero(~aside)
        judge = np.flatnonzero(aside) if aside.any() else learn
        best, kept, step = np.inf, None, 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 128)):
                step += 1
                hidden = np.tanh(x[rows] @ self.w1 + self.b1)
                error = (1 / (1 + np.exp(-(hidden @ self.w2 + self.b2[0]))) - y[rows]) / len(rows)
                back = np.outer(error, self.w2) * (1 - hidden ** 2)
                slope = {"w1": x[rows].T @ back + 1e-4 * self.w1, "b1": back.sum(axis=0), "w2": hidden.T @ error + 1e-4 * self.w2, "b2": error.sum(keepdims=True)}
                for n in names:
                    m, v = moment[n]
                    m += 0.1 * (slope[n] - m)
                    v += 0.001 * (slope[n] ** 2 - v)
                    setattr(self, n, getattr(self, n) - 0.005 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8))
            loss = self._loss(self._logit(x[judge]), y[judge], 1.0)
            if loss < best:
                best, kept = loss, {n: getattr(self, n).copy() for n in names}
        for n, value in kept.items():
            setattr(self, n, value)
        logit = self._logit(x[judge])
        # targets as sure as so many labels allow, or labels that are parted without a fault would call for temperature zero
        ones = y[judge].sum()
        target = np.where(y[judge] > 0, (ones + 1) / (ones + 2), 1 / (len(judge) - ones + 2))
        grid = np.exp(np.linspace(np.log(0.25), np.log(32), 181))
        self.temperature = float(grid[np.argmin([self._loss(logit, target, t) for t in grid])])

    @staticmethod
    def _loss(logit: np.ndarray, y: np.ndarray, temperature: float) -> float:
        z = logit / temperature
        return float(np.mean(np.logaddexp(0, z) - y * z))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._logit(self._standard(x)) / self.temperature))


class Model:
    def __init__(self, numbers: dict[bytes, int], vectors: np.ndarray, network: Network | None, share: float):
        self.numbers, self.vectors, self.network, self.share = numbers, vectors, network, share

    def score(self, column: pa.Array) -> np.ndarray:
        """Scores of a column of texts, some hundred at a time."""
        if self.network is None:
            return np.full(len(column), self.share)
        out = [np.zeros(0)]
        for at in range(0, len(column), ROWS_AT_ONCE):
            x = np.stack([features(b, self.numbers, self.vectors) for b in bodies(column.slice(at, ROWS_AT_ONCE))])
            out.append(np.round(self.network.probability(x), 9))  # products of matrices differ in the last bits by batch
        return np.concatenate(out)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
        label_col: str = "quality", sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """A model from at most ``sample`` labels for which ``learn`` (of the column ``doc_id``) holds."""
    marked = labels.select(named(label_id).cast("long").alias("doc_id"), named(label_col).cast("int").alias("label")).dropna()
    chosen = marked.where(learn).groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = staged(chosen, "classifier-labels")  # at most ``sample`` rows, so it may be broadcast
    rows = staged(ids_and_bytes(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id"), "classifier-sample")
    numbers, vectors = word_vectors(rows.select("doc_id", "body"), vocabulary)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(b, numbers, vectors).tobytes() for b in bodies(batch.column("body"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())], ["doc_id", "label", "x"])

    known = sorted((r.doc_id, r.label, bytes(r.x)) for r in rows.mapInArrow(pooled, "doc_id long, label int, x binary").collect())
    y = np.array([label > 0 for _, label, _ in known], bool)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Model(numbers, vectors, None, share)
    x = np.stack([np.frombuffer(v, np.float32) for _, _, v in known]).astype(float)
    shuffled = np.random.default_rng(1).permutation(len(y))
    return Model(numbers, vectors, Network(x[shuffled], y[shuffled]), share)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(batch.column("body"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return ids_and_bytes(docs, id_col, text_col).mapInArrow(judged, "doc_id long, score double")


def learns(modulus: int = 5) -> Column:
    """Ids that may be learned from: their crc32 leaves something modulo ``modulus``."""
    return crc_mod(F.col("doc_id"), modulus) != 0


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, learns(), id_col, text_col, **options)
    return scored(docs, model, id_col, text_col).select(
        "doc_id", (~learns()).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns; the text must be a string."""
    model = fit(docs, labels, learns(), id_col, text_col, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(batch.column(text_col).cast(pa.binary()))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(passed, docs.schema)
