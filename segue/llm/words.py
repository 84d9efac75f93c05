"""Byte-level BPE by words: Spark splits the texts, and a word is encoded once for each table it stands in.

The pattern splits a text as the tokenizer's own pre-tokenizer does, so the ids of a text are the ids of its words one
after another. A text for which that may not hold (it holds a special token, or characters that Java's Unicode tables
do not know) counts as one word, which the tokenizers library then encodes whole.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The public pre-tokenizer pattern of byte-level BPE in Java's spelling, and its special token.
WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
    r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
)
SPECIAL = "<|endoftext|>"


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array; none for NULL and for the empty text."""
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit(SPECIAL)) | text.rlike(r"\p{Cn}")
    return F.when(odd, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def encode_words(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, number of ids of each word)."""
    ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for first in range(0, len(words), 8192):  # an encoding holds far more than its ids
        found = tokenizer(path).encode_batch_fast(words[first : first + 8192], add_special_tokens=False)
        counts.append(np.fromiter((len(x) for x in found), dtype=np.int64, count=len(found)))
        ids.append(np.fromiter(chain.from_iterable(x.ids for x in found), dtype=np.uint32, count=int(counts[-1].sum())))
    return np.concatenate(ids), np.concatenate(counts)


@lru_cache(maxsize=2)
def word_starts(path: str) -> np.ndarray:
    """For each id whether its piece begins with a space, which byte-level BPE writes as U+0120."""
    pieces = tokenizer(path).get_vocab(with_added_tokens=True)
    starts = np.zeros(max(pieces.values()) + 1, bool)
    starts[[i for piece, i in pieces.items() if piece.startswith("\u0120")]] = True
    return starts


def is_plain(word: str) -> bool:
    """A space and Latin letters: such words side by side are split again as they were, and each begins with a space."""
    return word[:1] == " " and word[1:].isalpha() and max(word) < "\u0250"


def encode_many(path: str, words: list[str], together: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """As `encode_words`; plain words are encoded `together` at a time, which costs half as much."""
    plain = np.fromiter(map(is_plain, words), bool, len(words))
    some = [w for w, p in zip(words, plain) if p]
    texts = ["".join(some[i : i + together]) for i in range(0, len(some), together)]
    plain_ids, _ = encode_words(path, texts)
    first = np.flatnonzero(word_starts(path)[plain_ids])
    if len(first) != len(some):  # a tokenizer of another kind
        return encode_words(path, words)
    rest_ids, rest_counts = encode_words(path, [w for w, p in zip(words, plain) if not p])
    counts = np.empty(len(words), np.int64)
    counts[plain], counts[~plain] = np.diff(np.append(first, len(plain_ids))), rest_counts
    both, sizes = np.concatenate([plain_ids, rest_ids]), np.concatenate([counts[plain], rest_counts])
    order = np.empty(len(words), np.int64)
    order[plain], order[~plain] = np.arange(len(some)), len(some) + np.arange(len(rest_counts))
    return spread(both, sizes, order), counts


class KnownWords:
    """The words that a worker process has met first, with their ids: a bounded table, so later texts mostly look up."""

    LIMIT, LONGEST = 1 << 18, 32  # some 50 MB with its table

    def __init__(self, path: str):
        # a Python table, as an Arrow set of values would be hashed again at each look-up
        self.path, self.words = path, {}
        self.ids, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, counts, place): word i has the ids of entry place[i] of a table given by its ids and their counts."""
        texts = words.to_pylist()
        place = np.fromiter((self.words.get(w, -1) for w in texts), np.int64, len(texts))
        missing = np.flatnonzero(place < 0)
        unknown = [texts[i] for i in missing.tolist()]
        new_ids, new_counts = encode_many(self.path, unknown)
        ids, counts = np.concatenate([self.ids, new_ids]), np.concatenate([self.counts, new_counts])
        place[missing] = len(self.words) + np.arange(len(missing))
        room = self.LIMIT - len(self.words)
        short = [i for i, w in enumerate(unknown) if len(w.encode()) <= self.LONGEST][: max(0, room)] if room > 0 else []
        if short:
            self.ids = np.concatenate([self.ids, spread(new_ids, new_counts, np.array(short))])
            self.counts = np.concatenate([self.counts, new_counts[short]])
            first = len(self.words)
            self.words.update((unknown[i], first + k) for k, i in enumerate(short))
        return ids, counts, place


@lru_cache(maxsize=2)
def known_words(path: str) -> KnownWords:
    return KnownWords(path)


def spread(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids at the positions that `codes` names: word `codes[0]`, then word `codes[1]` and so on."""
    each = counts[codes]
    ends = np.cumsum(each)
    first = (np.cumsum(counts) - counts)[codes]
    at = np.repeat(first - (ends - each), each) + np.arange(int(each.sum()))
    return ids[at]


def list_parts(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the values of all lists, the number of values in each list)."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    return lists.flatten(), sizes


def edges_of(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each text's ids begin and the last ends, from the number of ids of each word and of words of each text."""
    return np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))]


def encode_lists(path: str, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of ids of each text) for lists of words."""
    values, sizes = list_parts(lists)
    coded = values.dictionary_encode()
    ids, counts, place = known_words(path).find(coded.dictionary)
    place = place[np.asarray(coded.indices)]
    return spread(ids, counts, place), np.diff(edges_of(counts[place], sizes))


def encoded_lengths(path: str, lists: pa.Array) -> np.ndarray:
    """The number of ids of each text, for lists of words."""
    values, sizes = list_parts(lists)
    coded = values.dictionary_encode()
    _, counts, place = known_words(path).find(coded.dictionary)
    return np.diff(edges_of(counts[place[np.asarray(coded.indices)]], sizes))
