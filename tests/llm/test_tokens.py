"""Token counts, token files and BPE by words against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from segue.llm import bpe
from segue.llm.bpe import encode_decode
from segue.llm.token_counts import length_histogram, limit_table, quantiles
from segue.llm.token_files import TokenFile, bits_for, id_digests, pack, read_token_files, to_bytes, unpack, write_token_files
from segue.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, key string, ids string, words string, n_tokens string, bucket string"
TEXTS = [
    "plain words, and more words", None, "", " ", "  lead\n\n\ttrail  ", "it's we'll DON'T 12345 ½ ٣", "<|endoftext|>a <|endoftext|>",
    "!!<|endoftext|>  x", "naïve façade 你好 😀 é", "  wide　space", "new \U0001fae8 \U0001ccfa letters ͸", "x" * 3000, "nul\x00byte",
    "ab " * 2000, "plain words, and more words",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "k", "i", "w", "n", "b") for i, t in enumerate(TEXTS)] + [(None, "no id", *"abcde"), (3, "again", *"abcde"), (3, "again", *"abcde")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encode_decode(spark, docs, library):
    rows = encode_decode(docs, PATH, chunk_words=700, bucket_bytes=4000).collect()
    expected = []
    for r in docs.collect():
        ids = ids_of(library, r.text)
        expected.append((str(r.doc_id), ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in rows) == sorted(expected)
    assert encode_decode(docs.where("false"), PATH).count() == 0


def test_token_files(spark, docs, library):
    path = scratch_path(spark, "files")
    manifest = write_token_files(docs, path, PATH, shard_ids=300, step=3)
    assert manifest.count() > 1
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in id_digests(read_token_files(spark, path)).collect()]
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    expected, start = [], 0
    for r in rows:
        ids = [*ids_of(library, r.text), 0]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    empty = scratch_path(spark, "files")
    assert write_token_files(docs.where("false"), empty, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(bits=st.integers(1, 32), count=st.integers(0, 400), seed=st.integers(0, 99))
def test_bits_round_trip(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, count, dtype=np.uint64).astype(np.uint32)
    assert np.array_equal(unpack(pack(ids, bits), bits, count), ids)
    sizes = np.array([count // 3, 0, count - count // 3])
    file = TokenFile(to_bytes(pa.array([5, None, 7]), sizes, ids, bits, block=64))
    assert np.array_equal(file.read(0, count), ids) and file.present.tolist() == [True, False, True]
    assert all(np.array_equal(file.read(a, min(a + 70, count)), ids[a : a + 70]) for a in range(0, count, 37))
    assert np.array_equal(np.concatenate([file.document(i) for i in range(3)]), ids)


def test_bits_are_few_and_checked():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        pack(np.array([8], np.uint32), 3)


def test_limits(spark, docs, library):
    lengths = np.array([len(ids_of(library, r.text)) for r in docs.collect()])
    table = limit_table(length_histogram(docs, PATH))
    for r in table.collect():
        assert (r.n_docs, r.docs_over) == ((lengths == r.n_tokens).sum(), (lengths > r.n_tokens).sum())
        assert (r.kept_tokens, r.total_tokens) == (np.minimum(lengths, r.n_tokens).sum(), lengths.sum())
        assert (r.tokens_over, r.docs_upto) == (lengths[lengths > r.n_tokens].sum(), (lengths <= r.n_tokens).sum())
    assert table.count() == len(set(lengths.tolist()))
    found = {r.share: r.n_tokens for r in quantiles(table, [0.1, 0.5, 0.9, 1.0]).collect()}
    assert found == {q: int(np.quantile(lengths, q, method="inverted_cdf")) for q in (0.1, 0.5, 0.9, 1.0)}
    grouped = limit_table(length_histogram(docs, PATH, by=["key"]), by=["key"])
    assert {r.key: r.total_docs for r in grouped.collect()} == {"k": len(TEXTS), "a": 3}
    assert limit_table(length_histogram(docs.where("false"), PATH)).count() == 0




def test_chunks_move_in_bounded_rows_and_keep_no_batch(monkeypatch):
    monkeypatch.setattr(bpe, "PART_WORDS", 50)
    lists = pa.array([["a", " b"] * 20, [], [" c"] * 30, None, ["d"] * 120, [" b"]], pa.list_(pa.string()))
    keys = pa.array([3, 3, None, 5, 6, 7])
    values, sizes = bpe.list_parts(lists)

    def rows(asking):
        return list(bpe.chunk_rows([keys], [values.dictionary_encode()], [sizes], 2, asking))

    held, coded, size = [keys], [values.dictionary_encode()], [sizes]
    given = bpe.chunk_rows(held, coded, size, 2, False)
    first = next(given)
    assert not held and not coded and not size and first["bucket"] == bpe.ORDER
    heads = [bpe.from_blob(r["docs"]) for r in given]
    assert [h.column("key").to_pylist() for h in heads] == [[3, 3], [None, 5], [6, 7]]
    assert [sum(h.column("size").to_pylist()) for h in heads] == [40, 30, 121]  # a longer text is a row alone or ends one
    assert {r["chunk"] for r in rows(True)} == {first["chunk"]}
    asked = [w for r in rows(True) for w in bpe.from_blob(r["words"]).column("word").to_pylist()]
    assert sorted(asked) == [" b", " c", "a", "d"]
