"""Token files: ids packed in the fewest bits that the vocabulary needs, in blocks that can be read alone.

A file is little-endian: the magic, a header of five numbers (bits of an id, ids in a block, documents, ids, blocks),
the documents' ids (int64) with a byte each that says whether there is one, the end of each document among the file's
ids (uint64), the offset of each block and the end of the last (uint64), and the blocks. In a block, id i stands at
bit i * bits; a block is filled up to whole 64-bit words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.llm.text_bytes import release
from segue.llm.words import encode_lists, words_of

MAGIC = b"IDBITS01"
HEADER = np.dtype([("bits", "<u4"), ("block", "<u4"), ("docs", "<u8"), ("ids", "<u8"), ("blocks", "<u8")])
BLOCK = 8192
SHARD_IDS = 1 << 20


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below `vocabulary`."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """64 ids become `bits` words; the last group is filled up with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    groups = -(-len(ids) // 64)
    lanes = np.zeros(groups * 64, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(groups, 64).T)
    words = np.zeros((bits, groups), dtype=np.uint64)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(-1)


def unpack(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    words = np.ascontiguousarray(words.reshape(-1, bits).T)
    lanes = np.empty((64, words.shape[1]), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        lanes[i] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(-1)[:count]


def file_pieces(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> Iterator[bytes]:
    """One file, piece by piece. `block` is a multiple of 64, so that blocks pack alone as they do together."""
    blocks = -(-len(ids) // block)
    words = -(-len(ids) // 64) * bits
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(block // 64 * bits * 8), np.uint64(8 * words))
    yield MAGIC
    yield np.array([(bits, block, len(sizes), len(ids), blocks)], dtype=HEADER).tobytes()
    yield np.asarray(doc_ids.fill_null(0)).astype("<i8").tobytes()
    yield np.asarray(doc_ids.is_valid()).astype(np.uint8).tobytes()
    yield np.cumsum(sizes).astype("<u8").tobytes()
    yield offsets.astype("<u8").tobytes()
    for first in range(0, len(ids), 8 * block):
        yield pack(ids[first : first + 8 * block], bits).astype("<u8").tobytes()


def to_bytes(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    return b"".join(file_pieces(doc_ids, sizes, ids, bits, block))


class TokenFile:
    """A file's bytes, read by document or by place; only the blocks that are asked for are unpacked."""

    def __init__(self, raw: bytes | memoryview):
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a token file")
        head = np.frombuffer(raw, HEADER, 1, 8)[0]
        self.bits, self.block, self.n_docs, self.n_ids, blocks = (int(head[name]) for name in HEADER.names)
        at = 8 + HEADER.itemsize
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        self.present = np.frombuffer(raw, np.uint8, self.n_docs, at + 8 * self.n_docs).astype(bool)
        self.ends = np.frombuffer(raw, "<u8", self.n_docs, at + 9 * self.n_docs).astype(np.int64)
        at += 17 * self.n_docs
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, at).astype(np.int64)
        self.data = memoryview(raw)[at + 8 * (blocks + 1) :]

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids from `start` up to `stop`."""
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        raw = self.data[self.offsets[first] : self.offsets[last + 1]]
        ids = unpack(np.frombuffer(raw, "<u8"), self.bits, stop - first * self.block)
        return ids[start - first * self.block :]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int | None = 0,
    vocabulary: int = 50257, shard_ids: int = SHARD_IDS, step: int = 1000,
) -> DataFrame:
    """Encode the texts and write them in ascending order of `key`; returns the manifest, which is kept beside them.

    NULL texts and empty texts give just the end id (or nothing, without one). NULL keys, and keys that are no whole
    number, come first; rows that repeat a key are ordered by their text. Other columns are not read. An empty table
    gives no files and an empty manifest.

    Rows are dealt by ranges of the key and the text's beginning, so a repeated key may be many tasks. A task cuts its rows in files of about
    `shard_ids` ids, encoding `step` texts at a time and writing a file block by block, so memory does not grow with the
    range. A file's name holds the attempt that wrote it, and only the files of attempts that Spark has accepted are in
    the manifest: a lost executor leaves at most files that no reader looks at.
    """
    from pyarrow import fs

    folder = qualified(docs.sparkSession, path)
    bits = bits_for(max(vocabulary, (end_id or 0) + 1))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        held, number = [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:05d}-{attempt}.bits"
            keys = pa.concat_arrays([k for k, _, _ in held])
            sizes, ids = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            with system.open_output_stream(f"{base}/{name}") as out:
                for piece in file_pieces(keys, sizes, ids, bits):
                    out.write(piece)
            row = {"part": part, "number": number, "name": name, "n_docs": len(sizes), "n_ids": len(ids)}
            return pa.RecordBatch.from_pylist([row], schema=manifest)

        for batch in batches:
            for piece in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                ids, sizes = encode_lists(tokenizer_path, piece.column(1))
                if end_id is not None:
                    ids, sizes = np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
                # copied, as a slice would keep its whole batch
                held.append((pa.concat_arrays([piece.column(0), piece.column(0).slice(0, 0)]), sizes, ids.astype(np.uint32)))
                if sum(len(h[2]) for h in held) >= shard_ids:
                    yield flush()
                    held, number = [], number + 1
                    release()
        if held:
            yield flush()
        held = []
        release()

    manifest = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    ordered = docs.select(F.col(key).try_cast("bigint").alias("key"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("key", F.left("text", F.lit(64))).sortWithinPartitions("key", "text")
    rows = ordered.select("key", words_of(F.col("text")).alias("words"))
    written = rows.mapInArrow(save, "part bigint, number bigint, name string, n_docs bigint, n_ids bigint")
    written.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, place, start, ids): the documents of all files, read back by Spark's reader of binary files.

    place is a document's number in its file, start the number of ids in all documents before it. Files that no
    manifest names are left out. The running sum over files has one small row for each file.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = TokenFile(raw.as_buffer())
                for first in range(0, file.n_docs, 250):
                    last = min(first + 250, file.n_docs)
                    edges = np.concatenate(([file.ends[first - 1] if first else 0], file.ends[first:last]))
                    ids = pa.array(file.read(int(edges[0]), int(edges[-1])).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * (last - first)), pa.array(file.doc_ids[first:last], mask=~file.present[first:last]),
                        pa.array(np.arange(first, last)), pa.array(edges[:-1]),
                        pa.ListArray.from_arrays(pa.array((edges - edges[0]).astype(np.int32)), ids),
                    ], names=["name", "doc_id", "place", "inside", "ids"])
            release()

    manifest = spark.read.parquet(f"{path}/manifest")
    before = W.partitionBy(F.lit(0)).orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    starts = manifest.select(F.col("name").alias("file"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.bits").load(path)
    raw = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    rows = raw.mapInArrow(load, "name string, doc_id bigint, place bigint, inside bigint, ids array<int>")
    joined = rows.join(starts, F.col("name") == F.col("file"))
    return joined.select("doc_id", "place", (F.col("before") + F.col("inside")).alias("start"), "ids")


def id_digests(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of `read_token_files`; the checksum is over little-endian 32-bit ids."""
    import zlib

    @F.pandas_udf("bigint")
    def checksum(ids):
        return ids.map(lambda x: zlib.crc32(np.asarray(x, dtype="<u4").tobytes()))

    return documents.select(
        "doc_id", "start", F.size("ids").cast("bigint").alias("n_tokens"), checksum("ids").alias("ids_crc32")
    )


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, by Spark's default file system, as file systems outside Spark want it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file:///") else full
