"""Exact words of Arrow batches: byte slices, word strings and their codes.

Unlike a hash of a word, a code of a dictionary tells any two words apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def slices(offsets: np.ndarray, data: np.ndarray, is_break: np.ndarray, size: int = SLICE_BYTES):
    """Byte ranges of about ``size`` that end behind a break or a document; a longer run without any stays whole."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        if end < n:
            doc = offsets[np.searchsorted(offsets, end, "right") - 1]
            gaps = np.flatnonzero(is_break[data[max(at, doc):end]])
            cut = max(at, doc) + gaps[-1] + 1 if len(gaps) else doc
            while cut <= at:  # one run fills the slice: go on to its end
                stop = offsets[np.searchsorted(offsets, end, "right")]
                step = min(end + size, stop)
                gaps = np.flatnonzero(is_break[data[end:step]])
                cut = end + gaps[0] + 1 if len(gaps) else step if step == stop else at
                end = step
            end = cut
        yield at, end
        at = end


def word_spans(part: np.ndarray, is_word: np.ndarray, starts_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; a run ends where a document starts."""
    word = is_word[part]
    first = word.copy()
    first[1:] &= ~word[:-1] | starts_doc[1:]
    last = word.copy()
    last[:-1] &= ~word[1:] | starts_doc[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_array(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> pa.Array:
    """The words as binary strings, A-Z lower-cased."""
    body = _FOLD[part[is_word[part]]]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def encode(words: list[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    """One code a word and the dictionary of the codes."""
    coded = pa.chunked_array(words, pa.large_binary()).combine_chunks().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def slice_documents(offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the documents with bytes in the range, and the first byte of each in it."""
    a, b = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
    return np.arange(a, b), np.maximum(offsets[a:b], lo) - lo
