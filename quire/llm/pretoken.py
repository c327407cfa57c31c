"""Vectorised pre-tokenisation and cached piece encoding for byte-level BPE.

``split`` cuts texts into the matches of the public byte-level BPE pattern
without a regex engine: every code point becomes a class, every class a
transition function of a small automaton, and an associative scan over those
functions gives the automaton's state before each code point. A match starts
where the (state, class) pair says so; white-space runs need one look-ahead.

All of it works on UTF-8 bytes: the bytes of a code point have its class, and
no class starts a match after itself, so the later bytes change nothing. Most
functions are constant (the state after a letter is "in letters" whatever it
was), so the scan runs over the others and the one code point before each run
of them.

``PieceIds`` turns the pieces into token ids: pieces are dictionary-encoded,
only pieces not seen before reach the encoder, and the ids are gathered.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Character classes. LS, LP: a letter that ends, or is the first of two that
# end, one of the pattern's apostrophe forms, L2 the second of them; WS: white
# space but U+0020.
L, N, O, SP, WS, AP, LS, LP, L2 = range(9)
# States before a code point: at a text's start, in a run of letters, digits or
# others, after U+0020, after other white space, after an apostrophe that
# starts a match, inside a two-letter apostrophe form, after a whole one.
S0, SL, SN, SO, SSP, SWS, SA, SA1, SEND = range(9)

_NEXT = np.empty((9, 9), np.uint8)  # the class's function: state before -> state after
_NEXT[L], _NEXT[N], _NEXT[O], _NEXT[SP], _NEXT[WS] = SL, SN, SO, SSP, SWS
_NEXT[[LS, LP, L2]] = SL
_NEXT[L2, SA1] = SEND
_NEXT[LS, SA], _NEXT[LP, SA] = SEND, SA1
_NEXT[AP] = [SA, SA, SA, SO, SO, SA, SO, SA, SA]
_VARIES = [AP, LS, LP, L2]  # classes whose function is not constant

_STARTS = np.ones((16, 16), np.uint8)  # (state, class): does a match start here?
for _c in (L, LS, LP, L2):
    _STARTS[[SL, SSP, SA1], _c] = 0
_STARTS[SA, [LS, LP]] = 0
_STARTS[[SN, SSP], N] = 0
_STARTS[[SO, SSP, SA], O] = 0
_STARTS[[SO, SSP, SA], AP] = 0
_STARTS[[SSP, SWS], SP] = 0
_STARTS[[SSP, SWS], WS] = 0


def _table(values: np.ndarray | list[int]) -> bytes:
    return bytes(np.asarray(values, np.uint8).reshape(-1).tolist()).ljust(256, b"\0")


_START_OF = _table(_STARTS)  # by 16 * state + class
_AFTER = _table(_NEXT[:, S0])  # the state after a class whose function is constant
_VARYING = _table([c in _VARIES for c in range(9)])


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the 18 generators (class, and class at a text's
    start): generator numbers, composition table, functions as state maps."""
    gens = [tuple(_NEXT[c]) for c in range(9)] + [(_NEXT[c][S0],) * 9 for c in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys(gens))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in gens:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    funcs = np.array(list(known), np.uint8)
    mul = np.empty((len(known), len(known)), np.uint16)
    for i, f in enumerate(known):
        for j, g in enumerate(known):
            mul[i, j] = known[tuple(g[s] for s in f)]
    return np.array([known[g] for g in gens], np.uint16), mul, funcs


_GEN, _MUL, _FUNCS = _monoid()
_BLOCK = 64


def _prefix(m: np.ndarray) -> np.ndarray:
    """Inclusive scan of composition over function numbers ``m``."""
    n = len(m)
    if n <= _BLOCK:
        out, acc = m.copy(), None
        for i in range(n):
            acc = m[i] if acc is None else _MUL[acc, m[i]]
            out[i] = acc
        return out
    cols = _columns(m)
    acc = np.empty_like(cols)
    acc[0] = cols[0]
    for j in range(1, _BLOCK):
        acc[j] = _MUL[acc[j - 1], cols[j]]
    before = _prefix(acc[-1])[:-1]
    acc[:, 1:] = _MUL[before[None, :], acc[:, 1:]]
    return acc.T.reshape(-1)[:n]


def _columns(m: np.ndarray) -> np.ndarray:
    """The sequence as consecutive columns of ``_BLOCK``, padded at the end."""
    rows = -(-len(m) // _BLOCK)
    padded = np.full(rows * _BLOCK, m[-1], m.dtype)
    padded[:len(m)] = m
    return np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)


def scan(gen: np.ndarray) -> np.ndarray:
    """State before each item, from its generator number.

    Blocks compose their functions, an associative scan over the block totals
    gives each block's entry state, and the blocks then apply their functions
    side by side.
    """
    cols = _columns(_GEN[gen])
    total = cols[0]
    for j in range(1, _BLOCK):
        total = _MUL[total, cols[j]]
    entry = np.empty(cols.shape[1], np.uint8)
    entry[0] = S0
    entry[1:] = _FUNCS[_prefix(total)[:-1], S0]
    out = np.empty(cols.shape, np.uint8)
    for j in range(_BLOCK):
        out[j] = entry
        entry = _FUNCS[cols[j], entry]
    return out.T.reshape(-1)[:len(gen)]


def states(cls: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """State before each byte from its class; ``starts``: where texts begin (the
    state there is not defined: a match starts in any case).

    After a constant function the state is known. The scan runs over the other
    functions, each run with the item before it, which is constant or a
    text's first (constant too) and so settles the run's entry state."""
    raw = cls.tobytes()
    before = np.empty(len(cls), np.uint8)
    before[0] = S0
    before[1:] = np.frombuffer(raw.translate(_AFTER), np.uint8)[:-1]
    varying = np.flatnonzero(np.frombuffer(raw.translate(_VARYING), np.uint8))
    if len(varying):
        at = np.union1d(varying, np.maximum(varying - 1, 0))
        gen = cls[at].astype(np.int64)
        gen[np.isin(at, starts, assume_unique=True)] += 9
        state = scan(gen)
        own = np.searchsorted(at, varying)
        before[varying] = state[own]
        after = _FUNCS[_GEN[gen[own]], state[own]]
        inner = varying + 1 < len(cls)
        before[varying[inner] + 1] = after[inner]
    return before


_class_table: np.ndarray | None = None


def class_table() -> np.ndarray:
    """Class of every code point, from the Unicode general categories."""
    global _class_table
    if _class_table is None:
        t = np.full(0x110000, O, np.uint8)
        for cp in range(0x110000):
            k = unicodedata.category(chr(cp))[0]
            if k == "L":
                t[cp] = L
            elif k == "N":
                t[cp] = N
            elif k == "Z":
                t[cp] = WS
        t[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85]] = WS
        t[0x20], t[0x27] = SP, AP
        _class_table = t
    return _class_table


def _classes(raw: bytes, data: np.ndarray) -> np.ndarray:
    """The class of each byte's code point."""
    table = class_table()
    cls = np.frombuffer(raw.translate(bytes(table[:128].tolist()).ljust(256, b"\0")), np.uint8).copy()
    lead = np.flatnonzero(data >= 0xC0)
    width = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
    for w in (2, 3, 4):
        at = lead[width == w]
        cp = (data[at] & (0x7F >> w)).astype(np.int32)
        for k in range(1, w):
            cp = cp << 6 | (data[at + k] & 0x3F)
        own = table[cp]
        for k in range(w):
            cls[at + k] = own
    return cls


def split(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts as one binary array, and each text's piece count."""
    own = [t.encode() for t in texts]
    lens = np.fromiter(map(len, own), np.int64, len(own))
    raw = b"".join(own)
    n = len(raw)
    if not n:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    ends = np.cumsum(lens)
    begin = (ends - lens)[lens > 0]
    data = np.frombuffer(raw, np.uint8)
    first = np.zeros(n + 2, bool)
    first[begin] = True
    first[n:] = True
    cls = _classes(raw, data)

    ap = np.flatnonzero(data == 0x27)
    ap = ap[~first[ap + 1]]
    if len(ap):
        one = data[ap + 1]
        cls[ap[np.isin(one, [0x73, 0x74, 0x6D, 0x64])] + 1] = LS
        two = np.where(first[ap + 2], 0, data[np.minimum(ap + 2, n - 1)])
        pair = ap[(np.isin(one, [0x72, 0x76]) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))]
        cls[pair + 1], cls[pair + 2] = LP, L2

    coded = states(cls, begin) << 4 | cls
    starts = np.frombuffer(bytearray(coded.tobytes().translate(_START_OF)), bool)
    starts[begin] = True
    space = (cls == SP) | (cls == WS)
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])  # before a non-space of the same text
    while len(inner := np.flatnonzero(data[last] & 0xC0 == 0x80)):  # from a code point's last byte to its first
        last[inner] -= 1
    starts[last] = True
    at = np.flatnonzero(starts)
    offsets = np.append(at, n).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return pieces, np.diff(np.searchsorted(at, np.concatenate([[0], ends])))


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``starts[i] .. starts[i] + lens[i] - 1``."""
    total = int(lens.sum())
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(total)


class PieceIds:
    """Token ids of texts, piece by piece, with a bounded cache of pieces.

    ``encode_new`` maps a list of distinct pieces to (flat ids, ids per piece).
    The cache holds at most ``cache_pieces`` pieces, or ``CACHE_BYTES`` of them,
    beside those of one call; when it is full the older half goes.
    """

    CACHE_BYTES = 32 << 20

    def __init__(self, encode_new: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 cache_pieces: int = 400_000):
        self._encode_new, self._max = encode_new, cache_pieces
        self.clear()

    def clear(self) -> None:
        """Forget all pieces."""
        self._known = pa.array([], pa.binary())
        self._flat = np.empty(0, np.int32)
        self._end = np.zeros(1, np.int64)

    def _trim(self) -> None:
        while len(self._known) > self._max or self._known.nbytes > self.CACHE_BYTES:
            half = len(self._known) // 2 + 1
            self._known = pa.concat_arrays([self._known.slice(half)])
            self._flat = self._flat[self._end[half]:].copy()
            self._end = self._end[half:] - self._end[half]

    def _add(self, pieces: pa.Array) -> None:
        flat, lens = self._encode_new(pieces.to_pylist())
        self._known = pa.concat_arrays([self._known, pieces])
        self._flat = np.concatenate([self._flat, flat])
        self._end = np.concatenate([self._end, self._end[-1] + np.cumsum(lens)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, ids per text, byte offset of each piece in its text, pieces per text."""
        pieces, counts = split(texts)
        if not len(pieces):
            zero = np.zeros(len(texts), np.int64)
            return np.empty(0, np.int32), zero, np.empty(0, np.int32), zero
        self._trim()
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        found = pc.index_in(distinct, value_set=self._known)
        slots = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            fresh = slots < 0
            slots[fresh] = len(self._known) + np.arange(found.null_count)
            self._add(distinct.filter(pa.array(fresh)))
        slots = slots[coded.indices.to_numpy(zero_copy_only=False)]
        starts = self._end[slots]
        lens = self._end[slots + 1] - starts
        ids = self._flat[ranges(starts, lens)]
        upto = np.concatenate([[0], np.cumsum(lens)])
        last = np.cumsum(counts)
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[:len(pieces)]
        text_start = np.repeat(offsets[np.minimum(last - counts, len(pieces) - 1)], counts)
        return ids, upto[last] - upto[last - counts], offsets - text_start, counts
