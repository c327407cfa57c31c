"""Words ``[^\\x20\\x09-\\x0D]+`` of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of all words in a row without what separates them; each word's end
    there; words per text. A word never spans two texts."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)
    space = _SPACE[data]
    word = ~space
    last = word[:-1] & space[1:]  # the data ends with a space
    kept = np.cumsum(word, dtype=np.int32 if len(word) < 1 << 31 else np.int64)
    at = np.flatnonzero(last)
    lens = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
    stops = np.cumsum(lens + 1)
    upto = np.searchsorted(at, stops)
    return data[word].tobytes(), kept[at].astype(np.int64), np.diff(upto, prepend=0)


def word_ids(flat: bytes, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words, and the distinct words."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def single_spaced(flat: bytes, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space after each; each word's start and end there."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    shift = np.arange(len(ends))
    out = np.full(len(flat) + len(ends), 0x20, np.uint8)
    place = np.ones(len(out), bool)
    place[ends + shift] = False
    out[place] = np.frombuffer(flat, np.uint8)
    return out.tobytes(), starts + shift, ends + shift


def text_of(counts: np.ndarray) -> np.ndarray:
    """The text number of each word."""
    return np.repeat(np.arange(len(counts)), counts)
