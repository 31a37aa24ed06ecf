"""SimHash near-deduplication by anchor-point covering.

A fingerprint has bit b set when over half of the document's shingle hashes have it set; fingerprints with at most two
differing bits are linked, and the connected groups are returned.

Anchors are the words of a covering code: two Golay codes of length 23 cover bits 0-22 and 23-45, and every 23-bit word
lies within distance 3 of exactly one code word. A fingerprint *probes* the one anchor within the covering radius of both
halves. It is *replicated* to every anchor it could share with a probe at distance two or less: those within radius
3 + e1 in the first and 3 + e2 in the second half, e1 + e2 <= 2 (about 61 of 2^24). So each link is seen at the probe's
anchor, where probes are compared with all that was replicated there.

Distinct fingerprints are compared, so copies cost nothing. An anchor with many probes is dealt out in chunks of probes,
and its replicated fingerprints stream past each chunk; a task holds one chunk and one block. Links are reduced to a star
per connected set before they leave a task, and the stars are joined by the alternating star contraction, each round a
written table.

Defined results: null text counts as empty; a text without words has fingerprint zero, linked like any other; rows that
repeat an id are rows of their own with equal results; a null id never becomes a component id unless its component has no
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import LOWER, fresh, ids_and_bytes, link_roots, named, staged

SHINGLE = 3
MAX_BITS = 2
SEED = 42
PROBES_PER_CHUNK = 512
PAIRS_AT_ONCE = 1 << 20
SHINGLES_AT_ONCE = 1 << 16

# Generator polynomial and parameters of the binary Golay code.
GOLAY = 0b101011100011
GOLAY_BITS = 23
GOLAY_RADIUS = 3


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, counted in blocks of shingles."""
    words = body.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    hashed, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), SHINGLES_AT_ONCE):
        block = slice(at, at + SHINGLES_AT_ONCE)
        values = np.array([hashed(joined[s:e], SEED) for s, e in zip(first[block], last[block])], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp: one row per input row, the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(b.as_buffer().to_pybytes(), shingle) for b in batch.column("body")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return ids_and_bytes(docs, id_col, text_col).mapInArrow(hashed, "doc_id long, fp long")


@lru_cache(1)
def _golay_cosets() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome its words of weight up to radius + MAX_BITS, lightest first.

    Returned are the syndromes of single bytes by place, the words, each syndrome's offset, and how many of its words
    have weight at most radius + e for e = 0..MAX_BITS.
    """
    def syndrome(word: int) -> int:
        for bit in range(GOLAY_BITS - 1, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    single = [syndrome(1 << bit) for bit in range(GOLAY_BITS)]
    words, syndromes, levels = [], [], []
    for weight in range(GOLAY_RADIUS + MAX_BITS + 1):
        chosen = np.array(list(combinations(range(GOLAY_BITS), weight)), dtype=np.int64)
        words.append(np.bitwise_or.reduce(1 << chosen, axis=1))
        syndromes.append(np.bitwise_xor.reduce(np.array(single)[chosen], axis=1))
        levels.append(np.full(len(chosen), max(0, weight - GOLAY_RADIUS)))
    word, syn, level = map(np.concatenate, (words, syndromes, levels))
    order = np.lexsort((level, syn))
    counts = np.stack([np.bincount(syn[level <= e], minlength=2048) for e in range(MAX_BITS + 1)], axis=1)
    offsets = np.concatenate([[0], np.cumsum(counts[:, -1])[:-1]])
    by_byte = np.array([[syndrome(v << 8 * place) if v << 8 * place < 1 << GOLAY_BITS else 0 for v in range(256)] for place in range(3)])
    return by_byte, word[order], offsets, counts


def _half(fp: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """23 bits of each fingerprint and their syndromes."""
    by_byte = _golay_cosets()[0]
    value = (fp >> np.uint64(shift)).astype(np.int64) & ((1 << GOLAY_BITS) - 1)
    return value, by_byte[0][value & 255] ^ by_byte[1][value >> 8 & 255] ^ by_byte[2][value >> 16]


def home(fp: np.ndarray) -> np.ndarray:
    """The one anchor at which each fingerprint probes."""
    _, words, offsets, _ = _golay_cosets()
    (low, low_syn), (high, high_syn) = _half(fp, 0), _half(fp, GOLAY_BITS)
    return (low ^ words[offsets[low_syn]]) >> 11 << 12 | (high ^ words[offsets[high_syn]]) >> 11


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All anchors of each fingerprint: index into ``fp``, anchor, and whether the fingerprint probes there."""
    _, words, offsets, counts = _golay_cosets()

    def spread(owner_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(owner_counts)), owner_counts)
        return owner, np.arange(len(owner)) - np.repeat(np.cumsum(owner_counts) - owner_counts, owner_counts)

    (low, low_syn), (high, high_syn) = _half(fp, 0), _half(fp, GOLAY_BITS)
    row, place = spread(counts[low_syn, MAX_BITS])
    level = (place[:, None] >= counts[low_syn[row], :MAX_BITS]).sum(axis=1)
    first = (low[row] ^ words[offsets[low_syn[row]] + place]) >> 11
    pair, place = spread(counts[high_syn[row], MAX_BITS - level])
    second = (high[row[pair]] ^ words[offsets[high_syn[row[pair]]] + place]) >> 11
    anchor = first[pair] << 12 | second
    return row[pair], anchor, anchor == home(fp)[row[pair]]


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(home(fp).astype(np.int32))], ["anchor"])


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        row, anchor, probe = anchors(fp)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor.astype(np.int32)), pa.array(probe), pa.array(fp[row].view(np.int64))], ["anchor", "probe", "fp"])


def _pairs(cell: np.ndarray, probe: np.ndarray, fp: np.ndarray, n_probes: np.ndarray, size: np.ndarray,
           start: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of the cells that ``start``, ``n_probes`` and ``size`` describe; probes come first in a cell."""
    work = n_probes * size
    at = 0
    while at < len(work):
        upto = max(at + 1, at + int(np.searchsorted(np.cumsum(work[at:]), PAIRS_AT_ONCE, "right")))
        w = work[at:upto]
        owner = np.repeat(np.arange(at, upto), w)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(w) - w, w)
        x = fp[start[owner] + inside // size[owner]]
        y = fp[start[owner] + inside % size[owner]]
        near = (np.bitwise_count(x ^ y) <= max_bits) & (x != y)
        yield x[near], y[near]
        at = upto


def _compare(max_bits: int):
    """Star links of rows that come sorted by cell, probes first."""

    def stars(u: list[np.ndarray], v: list[np.ndarray]) -> pa.RecordBatch:
        u, v = np.concatenate([np.zeros(0, np.uint64), *u]), np.concatenate([np.zeros(0, np.uint64), *v])
        node, root = link_roots(u.view(np.int64), v.view(np.int64)) if len(u) else (u.view(np.int64), v.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(node[node != root]), pa.array(root[node != root])], ["u", "v"])

    def against(kept: np.ndarray, members: np.ndarray) -> tuple[list, list]:
        u, v = [], []
        step = max(1, PAIRS_AT_ONCE // max(1, len(kept)))
        for at in range(0, len(members) if len(kept) else 0, step):
            block = members[at: at + step]
            near = (np.bitwise_count(kept[:, None] ^ block[None, :]) <= max_bits) & (kept[:, None] != block[None, :])
            i, j = np.nonzero(near)
            node, root = link_roots(kept[i], block[j]) if len(i) else (kept[:0], kept[:0])
            u.append(node), v.append(root)
        return u, v

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_cell, kept = None, np.zeros(0, np.uint64)  # the last cell so far and its probes
        earlier = np.zeros(0, np.uint64)  # members of it that came before its last probe
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy()
            probe = batch.column("probe").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            size = np.diff(np.concatenate([start, [len(cell)]]))
            n_probes = np.add.reduceat(probe.astype(np.int64), start)
            u, v = [], []
            first = 0
            if cell[0] == open_cell:  # the open cell goes on: its probes came first
                own = fp[: size[0]]
                new = own[: n_probes[0]]
                for a, b in (against(kept, own), against(new, earlier)):
                    u += a
                    v += b
                if n_probes[0]:
                    a, b = against(new, own)
                    u += a
                    v += b
                    earlier = np.concatenate([earlier, new])
                kept = np.concatenate([kept, new])
                first = 1
            for a, b in _pairs(cell, probe, fp, n_probes[first:], size[first:], start[first:], max_bits):
                u.append(a)
                v.append(b)
            if first < len(start):
                last = fp[start[-1]:][: n_probes[-1]]
                open_cell, kept, earlier = cell[-1], last, last
            yield stars(u, v)

    return compared


def links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = PROBES_PER_CHUNK) -> DataFrame:
    """(u, v): links between distinct fingerprints that connect exactly what links of ``max_bits`` connect."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the anchors cover at most {MAX_BITS} bits")
    spark = fps.sparkSession
    distinct = fps.select("fp").distinct()
    spread = distinct.mapInArrow(_replicate, "anchor int, probe boolean, fp long")
    crowded = (
        distinct.mapInArrow(_homes, "anchor int").groupBy("anchor").count().where(F.col("count") > chunk)
        .select("anchor", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    )
    crowded = staged(crowded, "simhash-crowded")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1)).cast("long")).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
    dealt = spread.join(crowded, "anchor", "left").select(
        "anchor", "fp", F.posexplode(every).alias("chunk", "same"), (F.col("probe") & (own == F.col("chunk"))).alias("probe"),
    )
    cells = (
        dealt.select((F.col("anchor").cast("long") * F.lit(1 << 24) + F.col("chunk")).alias("cell"), "probe", "fp")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell")
        .sortWithinPartitions("cell", F.desc("probe"))
    )
    return cells.mapInArrow(_compare(max_bits), "u long, v long").distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each linked node but the smallest of its component, with that smallest node.

    Alternates the large and the small star step until the links stand still; both keep every component connected.
    """
    edges = staged(edges, "simhash-links")
    mark = _mark(edges)
    while True:
        around = _both(edges)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = staged(
            around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "simhash-large")
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-small")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    roots = components(links(fps, max_bits)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    by_root = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    by_root = staged(by_root, "simhash-roots")
    named_roots = by_root.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = staged(by_root.join(named_roots, "root").select("fp", "component_id"), "simhash-components")
    return fps.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows that repeat that id are one document.

    A row without an id can't be named by a component, so it always stays.
    """
    groups = near_groups(docs, id_col, text_col, shingle, max_bits)
    key = fresh(docs, "near_id")
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    stays = docs.join(keep, named(id_col).cast("long") == F.col(key), "left_semi").dropDuplicates([id_col])
    return stays.unionByName(docs.where(named(id_col).isNull()))
