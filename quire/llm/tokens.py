"""Token ids by a public vocabulary, piece by piece (see ``pretoken``).

Distinct pieces go through the tokenizers library's BPE model. A byte-level
BPE tokenizer writes every byte of a match as one printable character and
encodes the match by itself, so the ids of a text's matches are those of the
library on the whole text. The file's added tokens (such as ``<|endoftext|>``)
are found in texts as the library does by default: texts are cut at them and
they have their own ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import accumulate

import numpy as np
from tokenizers import Tokenizer

from quire.llm.pretoken import PieceIds


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the other bytes, in order,
    for the code points from 256 on."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in itself]
    return {b: b for b in itself} | {b: 256 + i for i, b in enumerate(others)}


class AddedIds(PieceIds):
    """``PieceIds`` that first cuts texts at ``added`` tokens, the leftmost and of
    those the longest first; each is one piece with its id."""

    def __init__(self, encode_new: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], added: dict[str, int]):
        super().__init__(encode_new)
        self._added = added
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if not any(a in t for a in self._added for t in texts):
            return super().encode(texts)
        parts = [self._cut.split(t) for t in texts]  # every second part is an added token
        flat = [p for own in parts for p in own]
        n_parts = np.array([len(own) for own in parts])
        first = np.cumsum(n_parts) - n_parts
        odd = (np.arange(len(flat)) - np.repeat(first, n_parts)) % 2 == 1
        ids, counts, offsets, pieces = super().encode(["" if o else p for p, o in zip(flat, odd.tolist())])
        ids = np.insert(ids, np.cumsum(counts)[odd], [self._added[flat[i]] for i in np.flatnonzero(odd).tolist()])
        offsets = np.insert(offsets, np.cumsum(pieces)[odd], 0)
        counts, pieces = counts + odd, pieces + odd
        size = np.array([len(p.encode()) for p in flat])
        before = np.cumsum(size) - size
        offsets = offsets + np.repeat(before - np.repeat(before[first], n_parts), pieces)
        return ids, np.add.reduceat(counts, first), offsets.astype(np.int32), np.add.reduceat(pieces, first)


def library_ids(path: str) -> PieceIds:
    tokenizer = Tokenizer.from_file(path)
    tokenize = tokenizer.model.tokenize
    added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    if any(t.single_word or t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values()):
        raise ValueError("added tokens that depend on the text around them are not supported")
    written = np.array([c for _, c in sorted(byte_characters().items())], "<u4")

    def encode_new(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        chars = written[raw].tobytes().decode("utf-32-le")  # a character for each byte
        ends = list(accumulate(map(len, pieces)))
        flat: list[int] = []
        lens = []
        for lo, hi in zip([0, *ends], ends):
            ids = [t.id for t in tokenize(chars[lo:hi])]
            flat += ids
            lens.append(len(ids))
        return np.array(flat, np.int32), np.array(lens, np.int64)

    return AddedIds(encode_new, added) if added else PieceIds(encode_new)


_worker: dict[str, PieceIds] = {}


def worker_ids(path: str) -> PieceIds:
    """The Python worker's encoder; vocabulary and cached pieces (at most a few
    tens of MB) stay between tasks."""
    if path not in _worker:
        _worker[path] = library_ids(path)
    return _worker[path]
