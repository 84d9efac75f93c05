"""BPE encoding and decoding by a table of distinct words.

Spark splits the texts in words. A task packs its documents in chunks: the chunk's words by number, and the chunk's
distinct words apart. The distinct words go by hash to buckets, where each word of the whole corpus is encoded once, and
the ids go back to the chunks that asked. There they are put in the words' places and, through the table of pieces,
turned back into text. So a word crosses the network once for each chunk it stands in, however often it stands there.

The texts are read twice, once for the words and once for their places, which is cheaper than keeping both. A chunk is
named by a hash of all it holds, so both readings name it alike, and a chunk whose words were not answered stops the job.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from segue.llm.text_bytes import release
from segue.llm.words import edges_of, encode_words, list_parts, spread, tokenizer, words_of
from segue.session import stash

CHUNK_WORDS = 2_000_000
PART_WORDS = 1 << 17  # of a chunk's row of documents, so that no side holds a chunk's rows as one
HEAD, ORDER = -1, -2  # the rows of a chunk that are no words for a bucket
BUCKET_BYTES = 64 << 20
PACKED = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("docs", pa.binary()), ("codes", pa.binary()), ("words", pa.binary())])


def to_blob(**columns: np.ndarray | pa.Array) -> bytes:
    """Columns of one length as compressed bytes."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    batch = pa.RecordBatch.from_arrays(arrays, names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def chunk_rows(keys: list[pa.Array], coded: list[pa.Array], sizes: list[np.ndarray], buckets: int, asking: bool) -> Iterator[dict]:
    """The rows of one chunk, given its words by dictionaries: if `asking`, its distinct words for each bucket, else its
    documents, some in a row (HEAD), and the order in which the buckets' answers come (ORDER). The lists are emptied."""
    held = pa.chunked_array(coded).combine_chunks()
    coded.clear()
    words, codes = held.dictionary, np.asarray(held.indices)
    # frequent words get small numbers, whose upper bytes compress away
    by_count = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    number = np.empty(len(words), "<u4")
    number[by_count] = np.arange(len(words), dtype="<u4")
    codes = number[codes]
    words = words.take(pa.array(by_count))
    del held
    raw = [w.encode() for w in words.to_pylist()]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int32, len(words))
    order = np.argsort(bucket, kind="stable").astype(np.int32)
    size, key = np.concatenate(sizes), pa.concat_arrays(keys)
    sizes.clear()
    keys.clear()
    name = hashlib.blake2b(digest_size=16)
    for part in (repr(key.to_pylist()).encode(), size, codes, *raw):
        name.update(part)
    row = {"chunk": name.hexdigest(), "docs": None, "codes": None, "words": None}
    if not asking:
        yield row | {"bucket": ORDER, "words": to_blob(order=order)}
        ends = np.cumsum(size)
        cuts = [0, *(np.flatnonzero(np.diff(ends // PART_WORDS)) + 1).tolist(), len(size)]
        for first, last in zip(cuts, cuts[1:]):
            planes = codes[ends[first] - size[first] : ends[last - 1]].view(np.uint8).reshape(-1, 4)
            planes = to_blob(**{f"p{i}": np.ascontiguousarray(planes[:, i]) for i in range(4)})
            yield row | {"bucket": HEAD, "docs": to_blob(key=key[first:last], size=size[first:last]), "codes": planes}
        return
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        asked = words.take(pa.array(order[edges[b] : edges[b + 1]]))
        yield row | {"bucket": int(b), "words": to_blob(word=asked)}


def piece_table(path: str) -> list[bytes]:
    """The bytes of each id, by the tokenizer's own table: printable bytes stand for themselves, others are moved up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: byte-level BPE's alphabet
    moved = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(moved)}
    tokens = tokenizer(path).get_vocab(with_added_tokens=True)
    added = {x.content for x in tokenizer(path).get_added_tokens_decoder().values()}
    pieces = [b""] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        pieces[i] = token.encode() if token in added else bytes(byte_of[c] for c in token)
    return pieces


def put_back(rows: Iterator[pa.RecordBatch], tokenizer_path: str, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(key, ids, decoded) of one chunk from its documents and all answers, some documents at a time."""
    release()
    group = pa.Table.from_batches(rows, PACKED)
    bucket = np.asarray(group.column("bucket").combine_chunks())
    blobs = {int(b): i for i, b in enumerate(bucket) if b >= 0}
    answers = [list_parts(from_blob(group.column("words")[blobs[b]].as_buffer()).column("ids")) for b in sorted(blobs)]
    ids = np.concatenate([np.empty(0, np.uint32), *(np.asarray(v) for v, _ in answers)])
    counts = np.concatenate([np.empty(0, np.int64), *(n for _, n in answers)])
    del answers
    orders = np.flatnonzero(bucket == ORDER)  # one, or as many as there are copies of the chunk
    order = np.asarray(from_blob(group.column("words")[int(orders[0])].as_buffer()).column("order").combine_chunks()) if len(orders) else ()
    if len(orders) and len(order) != len(counts):
        raise ValueError("the two readings of the texts differ: write the table first")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(place), dtype=np.int32)
    for i in np.flatnonzero(bucket == HEAD):
        head = {name: from_blob(group.column(name)[int(i)].as_buffer()) for name in ("docs", "codes")}
        planes = np.column_stack([np.asarray(head["codes"].column(f"p{p}").combine_chunks()) for p in range(4)])
        at = place[np.ascontiguousarray(planes).view("<u4").reshape(-1)]
        keys, sizes = (head["docs"].column(name).combine_chunks() for name in ("key", "size"))
        del head, planes
        edges = np.concatenate(([0], np.cumsum(np.asarray(sizes))))
        pieces = piece_table_of(tokenizer_path)
        schema = pa.schema([("key", key_type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        for first in range(0, len(keys), 200):
            last = min(first + 200, len(keys))
            mine = at[edges[first] : edges[last]]
            found = spread(ids, counts, mine)
            ends = edges_of(counts[mine], np.asarray(sizes)[first:last])
            texts = [b"".join([pieces[i] for i in found[a:b].tolist()]).decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found.astype(np.int32)))
            # given on at once, so that neither side holds a chunk's texts
            yield pa.RecordBatch.from_arrays([keys[first:last], lists, pa.array(texts, pa.string())], schema=schema)
    del group, ids, counts
    release()


def encode_decode(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    chunk_words: int = CHUNK_WORDS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(key, ids, decoded) for every row of `docs`, as the tokenizers library encodes and decodes.

    NULL texts and empty texts have no ids and decode to the empty text. Rows that repeat a key, and NULL keys, are
    kept as they are, one result row for each. Other columns are not read. An empty table gives no rows. A special
    token's string in a text becomes its id, as in the library.

    Chunks are bounded by words (a longer text is a chunk of its own) and buckets by their share of the corpus, so no
    task holds more than that. Rows that do not come straight from a table are written to the shared folder first, as
    both readings must meet them in the same order.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    if re.search(r"\b(Join|Aggregate|Repartition\w*|RebalancePartitions|Sort|Window|Union|Generate|Limit|\w*RDD|\w*Map\w*)\b", plan):
        rows = stash(rows, "texts")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    kind = rows.schema["key"].dataType.simpleString()
    key_type = to_arrow_type(rows.schema["key"].dataType)

    def pack_chunks(asking: bool):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, coded, sizes, held = [], [], [], 0
            for batch in batches:
                for piece in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                    # neither is part of the batch, whose texts are not kept
                    keys.append(piece.column(0).take(pa.array(np.arange(len(piece)))))
                    values, size = list_parts(piece.column(1))
                    coded.append(values.dictionary_encode())
                    sizes.append(size)
                    held += len(values)
                    if held >= chunk_words:
                        for row in chunk_rows(keys, coded, sizes, buckets, asking):
                            yield pa.RecordBatch.from_pylist([row], schema=PACKED)
                        held = 0
                batch = piece = values = None
            if keys:
                for row in chunk_rows(keys, coded, sizes, buckets, asking):
                    yield pa.RecordBatch.from_pylist([row], schema=PACKED)
            release()

        return pack

    def decode_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return put_back(batches, tokenizer_path, key_type)

    def encode_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(batches, PACKED)
        asked = [from_blob(x.as_buffer()).column("word").combine_chunks() for x in group.column("words")]
        head = group.select(["chunk", "bucket"]).to_pylist()
        del group
        coded = pa.chunked_array(asked, pa.string()).combine_chunks().dictionary_encode()
        sizes = [len(words) for words in asked]
        del asked
        ids, counts = encode_words(tokenizer_path, coded.dictionary.to_pylist())
        codes, at = np.asarray(coded.indices), 0
        for row, size in zip(head, sizes, strict=True):
            mine = codes[at : at + size]
            at += size
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts[mine]))).astype(np.int32)), pa.array(spread(ids, counts, mine)))
            yield pa.RecordBatch.from_pylist([row | {"words": to_blob(ids=lists)}], schema=PACKED)
        del ids, counts, codes, coded
        release()

    split = rows.select("key", words_of(F.col("text")).alias("words"))
    chunk_schema = "chunk string, bucket int, docs binary, codes binary, words binary"
    asked = split.mapInArrow(pack_chunks(True), chunk_schema).groupBy("bucket").applyInArrow(encode_bucket, chunk_schema)
    whole = split.mapInArrow(pack_chunks(False), chunk_schema).unionByName(asked).groupBy("chunk").applyInArrow(decode_chunk, f"key {kind}, ids array<int>, decoded string")
    return whole.select(F.col("key").alias(key), "ids", "decoded")


_pieces: dict[str, list[bytes]] = {}


def piece_table_of(path: str) -> list[bytes]:
    if path not in _pieces:
        _pieces[path] = piece_table(path)
    return _pieces[path]


def encoding_digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of `encode_decode`."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        key, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
