"""Token-id files: canonical length-limited Huffman codes, blocks that decode alone.

A file set is a folder with two Parquet tables. ``code`` has the code length of every id that
occurs; codes follow from the lengths (canonical: by length, then by id). ``blocks`` has one row
per block: file and block number, the ids before it in its file, the documents it holds (whole
documents, in ascending doc_id order over blocks and files), their numbers of ids and bytes, the
bits, and the bit offset of every ``CHECKPOINT``-th id of each document. Each document starts at a byte of its own. A reader needs
one block and the code, and decodes from all checkpoints of many blocks at once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicflow.llm.tokens import encoded, encoder
from civicflow.session import partitions_for, scratch_dir

MAX_BITS = 16
CHECKPOINT = 128
BLOCK_IDS = 1 << 16
BLOCK = (
    "file_no int, block_no int, first long, doc_ids array<bigint>, n_ids array<bigint>, "
    "n_bytes array<bigint>, bits binary, marks binary"
)


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` (package-merge)."""
    if len(counts) > 1 << max_bits:
        raise ValueError(f"{len(counts)} ids do not fit into codes of {max_bits} bits")
    if len(counts) < 2:
        return dict.fromkeys(counts, 1)
    leaves = sorted((n, i) for i, n in counts.items())
    # A package is (weight, number of leaves it took from the sorted list, its two parts).
    level: list[tuple] = [(n, k, None) for k, (n, _) in enumerate(leaves)]
    plain = list(level)
    for _ in range(max_bits - 1):
        pairs = [
            (level[j][0] + level[j + 1][0], -1, (level[j], level[j + 1])) for j in range(0, len(level) - 1, 2)
        ]
        level = list(heapq.merge(plain, pairs, key=lambda p: p[0]))
    bits = [0] * len(leaves)
    todo = level[: 2 * len(leaves) - 2]
    while todo:
        _, leaf, parts = todo.pop()
        if parts is None:
            bits[leaf] += 1
        else:
            todo.extend(parts)
    return {i: b for (_, i), b in zip(leaves, bits)}


class Code:
    """Codes and the decoding table that follow from code lengths."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths.items(), key=lambda x: (x[1], x[0]))
        self.ids = np.array([i for i, _ in order], np.uint32)
        bits = np.array([b for _, b in order], np.int64)
        self.width = int(bits.max(initial=1))
        spans = np.int64(1) << (self.width - bits)
        starts = np.cumsum(spans) - spans
        size = int(self.ids.max(initial=0)) + 1
        self.code = np.zeros(size, np.uint32)
        self.bits = np.zeros(size, np.uint8)
        self.code[self.ids] = starts >> (self.width - bits)
        self.bits[self.ids] = bits
        # By the next ``width`` bits: the id in the upper part, its code length in the lowest byte.
        table = np.repeat(self.ids.astype(np.int64) << 8 | bits, spans)
        self.table = np.concatenate([table, np.zeros((1 << self.width) - len(table), np.int64)])

    def encode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of documents that end at ``ends`` in ``ids``: all bytes, the bytes of each
        document, and the bit offset of every checkpoint within its document."""
        starts = np.concatenate([[0], ends[:-1]])
        lens = self.bits[ids].astype(np.int64)
        past = np.concatenate([[0], np.cumsum(lens)])
        doc_bytes = (past[ends] - past[starts] + 7) >> 3
        first = (np.cumsum(doc_bytes) - doc_bytes) * 8
        within = past[:-1] - np.repeat(past[starts], ends - starts)
        at = within + np.repeat(first, ends - starts)
        value = self.code[ids].astype(np.int64) << (63 - lens - (at & 31))
        value = value.view(np.uint64) << np.uint64(1)
        total, word = int(doc_bytes.sum()), at >> 5
        # Words of 32 bits: codes do not overlap, so their sum is their union, and exact in a float.
        number = (total + 3 >> 2) + 2
        out = np.bincount(word, value >> np.uint64(32), number)
        out += np.bincount(word + 1, value & np.uint64(0xFFFFFFFF), number)
        marked = (np.arange(len(ids)) - np.repeat(starts, ends - starts)) % CHECKPOINT == 0
        return out.astype(np.uint32).astype(">u4").tobytes()[:total], doc_bytes, within[marked]

    def decode(self, data: np.ndarray, begin: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Ids from bit ``begin`` on, ``number`` (at most CHECKPOINT) for each lane, one lane after
        the other. All lanes advance together, one id a step."""
        data = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
        ahead = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        order = np.argsort(-number, kind="stable")
        at, left = begin[order].copy(), number[order]
        shift, mask = 32 - self.width, (1 << self.width) - 1
        out = np.zeros((CHECKPOINT, len(at)), np.uint32)
        for step in range(int(left.max(initial=0))):
            live = int(np.searchsorted(-left, -step, "left"))
            pos = at[:live]
            found = self.table[(ahead[pos >> 3] >> (shift - (pos & 7))) & mask]
            out[step, :live] = found >> 8
            at[:live] += found & 255
        lanes = np.empty_like(order)
        lanes[order] = np.arange(len(order))
        wide = out.T[lanes]
        return wide[np.arange(CHECKPOINT) < number[:, None]]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, max_bits: int = MAX_BITS) -> None:
    """Tokenize ``docs`` (doc_id, text) and write a file set to ``path``.

    A null or empty text has the end id alone. Rows without doc_id come first; rows with the same
    doc_id keep no order among each other, but each stays whole. An empty table gives a file set
    without blocks. Texts are tokenized once; the global counts are sums over all ids, and only
    they (one number per id of the vocabulary) and one bound per file reach the driver.
    """
    spark = docs.sparkSession
    staged_path = scratch_dir(spark, "token-ids")
    dtype = encoder(tokenizer).dtype

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, counts in encoded(batches, tokenizer, end_id):
            ends = np.cumsum(counts) * dtype.itemsize
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            values = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, offsets.buffers()[1], pa.py_buffer(ids)])
            # Counts of these ids stand in the first row, so that the sums need not read ids again.
            number = np.bincount(ids)
            seen = np.flatnonzero(number)
            counted = np.stack([seen, number[seen]]).astype("<u4").tobytes()
            counts = pa.array([counted] + [None] * (len(keys) - 1), pa.binary())
            yield pa.record_batch([pa.array(keys, pa.int64()), values, counts], names=["doc_id", "ids", "counts"])

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    columns = "doc_id long, ids binary, counts binary"
    docs.mapInArrow(tokenize, columns).write.option("compression", "zstd").parquet(staged_path)
    staged = spark.read.schema(columns).parquet(staged_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counted in batch.column(0).drop_null():
                ids, number = np.frombuffer(counted.as_py(), "<u4").reshape(2, -1)
                if ids[-1] >= len(total):
                    total = np.append(total, np.zeros(ids[-1] + 1 - len(total), np.int64))
                total[ids] += number
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    counts = staged.select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    lengths = code_lengths({r.id: r.n for r in counts.collect()}, max_bits)
    spark.createDataFrame(sorted(lengths.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(lengths)

    files = partitions_for(staged)
    bounds = np.unique(staged.approxQuantile("doc_id", [k / files for k in range(1, files)], 0.1 / files))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        huffman = Code(code.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, held = part.column(0).to_pylist(), part.column(1).to_pylist()
                numbers = np.array([len(x) // dtype.itemsize for x in held])
                ids = np.frombuffer(b"".join(held), dtype)
                data, size, marks = huffman.encode(ids, np.cumsum(numbers))
                ends, marked = np.cumsum(size), np.cumsum((numbers + CHECKPOINT - 1) // CHECKPOINT)
                bits = [data[e - n : e] for e, n in zip(ends, size)]
                points = [x.astype("<u8").tobytes() for x in np.split(marks, marked[:-1])]
                file_no = [0 if k is None else int(np.searchsorted(bounds, k, "right")) for k in keys]
                yield pa.record_batch(
                    [
                        pa.array(file_no, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(numbers, pa.int64()),
                        pa.array(bits, pa.binary()),
                        pa.array(points, pa.binary()),
                    ],
                    names=["file_no", "doc_id", "n_ids", "bits", "marks"],
                )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, file_no, block_no, first = [], 0, None, 0, 0

        def closed():
            keys, numbers, bits, marks = zip(*rows)
            many = pa.list_(pa.int64())
            columns = {
                "file_no": pa.array([file_no], pa.int32()),
                "block_no": pa.array([block_no], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "doc_ids": pa.array([list(keys)], many),
                "n_ids": pa.array([list(numbers)], many),
                "n_bytes": pa.array([[len(b) for b in bits]], many),
                "bits": pa.array([b"".join(bits)], pa.binary()),
                "marks": pa.array([b"".join(marks)], pa.binary()),
            }
            return pa.record_batch(list(columns.values()), names=list(columns))

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and (row[0] != file_no or size + row[2] > BLOCK_IDS):
                    yield closed()
                    same = row[0] == file_no
                    block_no, first = (block_no + 1, first + size) if same else (0, 0)
                    rows, size = [], 0
                file_no = row[0]
                rows.append(row[1:])
                size += row[2]
        if rows:
            yield closed()

    (
        staged.select("doc_id", "ids").mapInArrow(encode, "file_no int, doc_id long, n_ids long, bits binary, marks binary")
        .repartitionById(files, "file_no")
        .sortWithinPartitions("file_no", "doc_id")
        .mapInArrow(blocks, BLOCK)
        .write.parquet(f"{path}/blocks")
    )
    code.unpersist()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: doc_id, start (ids of all documents before it), n_tokens, ids
    (unsigned 32 bits, little-endian)."""
    stored = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    lengths = {r.id: r.bits for r in spark.read.schema("id long, bits int").parquet(f"{path}/code").collect()}
    code = spark.sparkContext.broadcast(lengths)

    held = F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    by_file = stored.groupBy("file_no").agg(F.max(F.col("first") + held).alias("in_file"))
    before = F.sum("in_file").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    # One row per file, of which there are as many as shuffle partitions when it was written.
    by_file = F.broadcast(by_file.select("file_no", F.coalesce(before, F.lit(0)).alias("file_start")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        huffman = Code(code.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 8):
                part = batch.slice(at, 8)
                rows = part.to_pylist()
                numbers = np.concatenate([np.array(r["n_ids"], np.int64) for r in rows])
                size = np.concatenate([np.array(r["n_bytes"], np.int64) for r in rows])
                data = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8)
                marks = np.frombuffer(b"".join(r["marks"] for r in rows), "<u8").astype(np.int64)
                lanes = (numbers + CHECKPOINT - 1) // CHECKPOINT
                begin = marks + np.repeat((np.cumsum(size) - size) * 8, lanes)
                nth = np.arange(len(marks)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
                count = np.minimum(np.repeat(numbers, lanes) - nth * CHECKPOINT, CHECKPOINT)
                flat = huffman.decode(data, begin, count).astype("<u4").tobytes()
                ends = np.cumsum(numbers)
                start = [r["first"] + np.cumsum(r["n_ids"]) - r["n_ids"] for r in rows]
                columns = {
                    "file_no": pa.array([r["file_no"] for r in rows for _ in r["n_ids"]], pa.int32()),
                    "doc_id": pa.array([k for r in rows for k in r["doc_ids"]], pa.int64()),
                    "in_file": pa.array(np.concatenate(start), pa.int64()),
                    "n_tokens": pa.array(numbers, pa.int64()),
                    "ids": pa.array([flat[4 * (e - n) : 4 * e] for e, n in zip(ends, numbers)], pa.binary()),
                }
                yield pa.record_batch(list(columns.values()), names=list(columns))

    decoded = stored.mapInArrow(decode, "file_no int, doc_id long, in_file long, n_tokens long, ids binary")
    start = (F.col("file_start") + F.col("in_file")).alias("start")
    return decoded.join(by_file, "file_no").select("doc_id", start, "n_tokens", "ids")
