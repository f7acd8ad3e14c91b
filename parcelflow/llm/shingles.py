"""Word n-grams of whole texts as 64-bit values, a batch at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_values(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One value a word (lower case, split at white space) of all texts one
    after another, and the number of words of each text."""
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(
        pc.fill_null(texts, "").cast(pa.large_string()))))
    parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy(zero_copy_only=False)
    value = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    real = np.array([bool(w) for w in names], bool)[code] if len(names) else np.zeros(0, bool)
    return value[code[real]], np.bincount(parent[real], minlength=len(texts))


def gram_values(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The value of every run of ``words`` words, text after text, and the
    number of each text's.  A text of fewer words has one gram, all its words;
    one without a word has none."""
    value, count = word_values(texts)
    begin = np.cumsum(count) - count
    size = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    short = np.repeat(np.where(count < words, count, words), size)
    gram = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            inside = short > k
            part = value[np.minimum(at + k, max(len(value) - 1, 0))] if len(value) else gram
            gram = np.where(inside, mixed(gram * _ODD + part + np.uint64(k + 1)), gram)
    return gram, size


def sums_of(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The wrapped 64-bit sum of each run of ``size`` values."""
    with np.errstate(over="ignore"):
        upto = np.r_[np.uint64(0), np.cumsum(values, dtype=np.uint64)]
    end = np.cumsum(size)
    with np.errstate(over="ignore"):
        return upto[end] - upto[end - size]


def sequence_digest(gram: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each text's sequence of grams: the same for two texts when
    they have the same words in the same order."""
    end = np.cumsum(size)
    place = (np.arange(len(gram)) - np.repeat(end - size, size)).astype(np.uint64)
    with np.errstate(over="ignore"):
        first = sums_of(mixed(gram + place * _ODD), size)
        second = sums_of(mixed((gram ^ _ODD) * np.uint64(3) + place * np.uint64(0xD6E8FEB86659FD93)),
                         size)
    return first.view(np.int64), second.view(np.int64)
