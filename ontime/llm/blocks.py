"""Blocks of documents and buckets of hashed keys, for operators that must compare a corpus with itself.

A *block* holds some megabytes of documents as one row: an Arrow record batch and packed arrays. Blocks are written once
to a table bucketed by block number, so later passes read a block with what others said about it without moving it
again. A block *asks* each bucket about its own distinct keys, one packed row per block and bucket; a bucket, which sees the
rows of all blocks for its range of keys, *answers* each in the same order. What moves is proportional to the distinct keys
of a block, and a key that is everywhere costs one entry per block, however often it occurs in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.session import scratch_path

BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
MOST_FILE_BUCKETS = 50_000
#: A block's number and a row in it make a long: task, block of the task, row.
BLOCK_BITS, ROW_BITS = 20, 18


def bucket_count(total_bytes: int) -> int:
    """Buckets of keys for texts of so many bytes; each answers for about as many keys at every size."""
    return max(LEAST_BUCKETS, -(-total_bytes // BUCKET_BYTES))


def _cut(batches: Iterator[pa.RecordBatch], size_of: str, limit: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows whose ``size_of`` column holds about ``limit`` bytes, one row at least and 2^ROW_BITS at most."""
    held, size = [], 0
    for batch in batches:
        own = pc.binary_length(batch.column(size_of)).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.cumsum(own + max(1, limit >> ROW_BITS - 1))  # rows weigh something, so empty texts fill a block too
        start = 0
        while start < batch.num_rows:
            done = int(sizes[start - 1]) if start else 0
            stop = min(batch.num_rows, int(np.searchsorted(sizes, done + limit - size)) + 1)
            held.append(batch.slice(start, stop - start))
            size += int(sizes[stop - 1]) - done
            start = stop
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pack_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def home(rows: DataFrame, size_of: str, total_bytes: int, keep: list[str], describe: Callable[[pa.Table], dict[str, bytes]] | None = None,
         extra: tuple[str, ...] = (), limit: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """The blocks of ``rows`` as a table (block, rows, one binary column per name in ``extra``) and the table's name.

    ``describe`` computes the extra columns of a block; of the rows themselves the columns ``keep`` are stored.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, block in enumerate(_cut(batches, size_of, limit)):
            more = describe(block) if describe else {}
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << BLOCK_BITS | number], pa.int64()), pa.array([pack_rows(block.select(keep))], pa.binary()),
                 *[pa.array([more[name]], pa.binary()) for name in extra]], ["block", "rows", *extra])

    spark = rows.sparkSession
    blocks = rows.mapInArrow(written, "block long, rows binary" + "".join(f", {name} binary" for name in extra))
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = min(MOST_FILE_BUCKETS, max(1, -(-total_bytes // limit)))
    blocks.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name), name


def forget(df: DataFrame, name: str) -> None:
    """Take the block table out of the catalog once nothing reads it; its files go with the scratch folder."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def with_answers(blocks: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Each block with a list ``answers`` of its buckets' answers in the order of the buckets."""
    listed = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("answers"))
    return blocks.join(listed, "block", "left")


def buffers(column: pa.ChunkedArray) -> list[pa.Buffer]:
    """The values of a binary column without copying them."""
    return [value.as_buffer() for value in column]


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of each value, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def each_block(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """The wanted columns of one block after another."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in columns)
