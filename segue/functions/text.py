"""Text rules for vocabularies: ASCII lower case, punctuation removed, split on blanks, 1- to n-grams."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from segue.functions.scalars import _col

# The punctuation that is stripped before splitting, and the blanks beside the space.
PUNCTUATION = """!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"""
BLANKS = "\t\n\r"


def standardize(c: Column | str) -> Column:
    return F.translate(_col(c), string.ascii_uppercase + PUNCTUATION, string.ascii_lowercase)


def tokens(c: Column | str) -> Column:
    """Words of the standardized text, in order. One pass over the text lowers, strips and makes all blanks spaces."""
    clean = F.translate(_col(c), string.ascii_uppercase + BLANKS + PUNCTUATION, string.ascii_lowercase + " " * len(BLANKS))
    return F.array_remove(F.split(clean, " "), "")


def ngrams(words: Column | str, n: int = 2) -> Column:
    """All 1- to n-grams of a word array, shorter grams first, words joined with a blank.

    The word array is held in a one-element array while the grams are made, so it is computed once per row.
    """

    def grams(held: Column) -> Column:
        sizes = [held]
        for size in range(2, n + 1):
            count = F.greatest(F.size(held) - F.lit(size - 1), F.lit(0))
            heads, tails = F.slice(sizes[-1], 1, count), F.slice(held, size, count)
            sizes.append(F.zip_with(heads, tails, lambda a, b: F.concat_ws(" ", a, b)))
        return F.concat(*sizes)

    words = _col(words)
    return F.transform(F.array(words), grams)[0] if n > 1 else words
