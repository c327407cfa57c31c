"""Document fingerprints by SpotSigs: chains of content words after common words.

Words are runs of letters and digits, lower-cased. Every common word (an anchor, of
``ANCHORS``) with the ``CHAIN`` content words that follow it is a signature;
near the end of a text the chain is shorter. A text's fingerprint is the
multiset of its signatures as 64-bit hashes, named by a 128-bit hash of it. A
text without any signature has one, its words in a row (or, if it has none, its
characters); an empty text has the empty fingerprint.

The likeness of two fingerprints is their Jaccard coefficient as multisets: the
sum of the smaller counts over that of the larger; of two empty ones it is 1.
Pairs are partitioned by set length before they are compared: a likeness is at
most the shorter length over the longer, so pairs that cannot reach ``least``
are pruned without a look at their signatures, and of the others the rest is
pruned when a first part of the hash range leaves too little to agree on.

A null text is empty. Rows without an id come first, rows of one id are ordered
by a hash of their text; repeated rows follow each other. An empty table gives
no rows; a single document is followed by itself. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import doc_texts, settle, text_blocks
from quire.llm.exchange import mix, run_starts

# Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be but by for from had has have he his in is it its not of on or that the their they this to was were which with
als am auch auf aus bei das dem den der des die ein eine einer er es für hat im ist mit nach nicht sich sie sind und von war wie zu zum
au aux avec ce cette dans de des du elle en est et il la le les ne nous on ou par pas pour qu que qui se sur un une vous
al como con del el ella en entre era es está esta este la las lo los más no para pero por que se si sin sobre su sus un una y
""".split()
CHAIN = 3
BLOCK_TEXT = 2 << 20  # text bytes that are fingerprinted at once

_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(5001, 5257, dtype=np.uint64))
# all ASCII but letters and digits parts words
_PARTS = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))


def _word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, wherever it is."""
    n = len(data)
    up = np.full(n, _BASE, np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word."""
    own = [t.lower().encode() for t in texts]
    data = np.frombuffer(b" ".join(own).translate(_PARTS) + b" ", np.uint8)
    word = data != 0x20
    edge = np.diff(word.astype(np.int8), prepend=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ends = np.cumsum([len(b) + 1 for b in own])
    return _word_hashes(data, start, stop), np.searchsorted(ends, start, side="right")


_ANCHOR_HASHES = np.sort(_words([" ".join(ANCHORS)])[0])


def signatures(texts: list[str], chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """All texts' signatures in a row, sorted within each text, and where each
    text's begin (one more at the end)."""
    words, of = _words(texts)
    anchor = _ANCHOR_HASHES[np.minimum(np.searchsorted(_ANCHOR_HASHES, words), len(_ANCHOR_HASHES) - 1)] == words
    content, content_of = words[~anchor], of[~anchor]
    spot = np.flatnonzero(anchor)
    first = np.cumsum(~anchor)[spot]  # the first content word after the anchor
    h = words[spot]
    any_word = np.zeros(len(spot), bool)
    for k in range(chain):
        at = np.minimum(first + k, len(content) - 1)
        inside = (first + k < len(content)) & (content_of[at] == of[spot]) if len(content) else np.zeros(len(spot), bool)
        any_word |= inside
        h = mix(h * np.uint64(_BASE) + (np.where(inside, content[at], 0) if len(content) else np.uint64(0)).astype(np.uint64))
    sig, sig_of = h[any_word], of[spot][any_word]
    bare = np.flatnonzero(np.bincount(sig_of, minlength=len(texts)) == 0)
    extra, extra_of = [], []
    for i in bare.tolist():
        if texts[i]:
            lo, hi = np.searchsorted(of, [i, i + 1])
            own = words[lo:hi].tobytes() or texts[i].encode()
            extra.append(int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little"))
            extra_of.append(i)
    sig, sig_of = np.concatenate([sig, np.array(extra, np.uint64)]), np.concatenate([sig_of, np.array(extra_of, np.int64)])
    order = np.lexsort((sig, sig_of))
    return sig[order], np.searchsorted(sig_of[order], np.arange(len(texts) + 1))


def names(sigs: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The fingerprints' names: equal for equal multisets."""
    raw = sigs.astype("<u8")
    return [hashlib.blake2b(raw[a:b], digest_size=16).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _gathered(sigs: np.ndarray, bounds: np.ndarray, which: np.ndarray, below: np.uint64 | None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the chosen fingerprints and the place of each in ``which``."""
    size = bounds[which + 1] - bounds[which]
    at = np.repeat(bounds[which] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    of, own = np.repeat(np.arange(len(which)), size), sigs[at]
    if below is not None:
        some = own < below
        of, own = of[some], own[some]
    return own, of


def _agreement(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """For each of ``n`` pairs the sum of the smaller counts of each signature."""
    sig, pair = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    side = np.repeat([0, 1], [len(a[0]), len(b[0])])
    order = np.lexsort((sig, pair))
    sig, pair, side = sig[order], pair[order], side[order]
    new = run_starts(pair, sig)
    run = np.cumsum(new) - 1
    left = np.bincount(run, weights=side == 0, minlength=int(new.sum()))
    right = np.bincount(run, weights=side == 1, minlength=int(new.sum()))
    return np.bincount(pair[new], weights=np.minimum(left, right), minlength=n)


def likeness(sigs: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray, least: float = 0.0) -> np.ndarray:
    """Likeness of the fingerprints ``a`` and ``b``, pair by pair; 0 for pairs that
    are pruned because theirs is below ``least``."""
    size = np.diff(bounds)
    short, long = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
    out = np.where(long == 0, 1.0, 0.0)
    open_ = np.flatnonzero((short > 0) & (short >= least * long))
    length_class = np.frexp(long[open_])[1]  # pairs of about equal lengths are compared together
    for c in np.unique(length_class).tolist():
        own = open_[length_class == c]
        if least > 0 and c > 6:  # long sets: a 16th of the hash range first
            below = np.uint64(1 << 60)
            x, y = (_gathered(sigs, bounds, s[own], below) for s in (a, b))
            both = _agreement(x, y, len(own))
            missed = np.maximum(np.bincount(x[1], minlength=len(own)), np.bincount(y[1], minlength=len(own))) - both
            own = own[missed <= (1 - least) * long[own]]  # each missed one takes its part of the longer set
        both = _agreement(_gathered(sigs, bounds, a[own], None), _gathered(sigs, bounds, b[own], None), len(own))
        found = both / (size[a[own]] + size[b[own]] - both)
        out[own] = np.where(found >= least, found, 0.0)
    return out


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``(doc_id, fingerprint, signatures)`` for every document: the name and the
    sorted signatures themselves (as signed integers, sorted as unsigned ones)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, max_bytes=BLOCK_TEXT):
            sigs, bounds = signatures(texts, chain)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sigs.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names(sigs, bounds)), lists], ["doc_id", "fingerprint", "signatures"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, fingerprint string, signatures array<bigint>")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the next document's start."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_REPORT_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _report(ids: list, texts: list[str], chain: int) -> pa.RecordBatch:
    """Rows for all texts but the last, each against the one after it."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    sigs, bounds = signatures(texts + changed, chain)
    name = names(sigs, bounds)
    one = np.arange(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()), pa.array(name[:n], pa.string()),
         pa.array(name[n + 1:], pa.string()), pa.array(likeness(sigs, bounds, one, n + 1 + one)), pa.array(likeness(sigs, bounds, one, one + 1))],
        schema=_REPORT)


def neighbours(docs: DataFrame, chain: int = CHAIN, partitions: int | None = None) -> DataFrame:
    """For every document, in the order of their ids: ``n_chars``, the SHA-256 of
    its ``edited`` text, both fingerprints, and the likeness of its own to the
    edited text's and the next document's (after the last: the first's).

    Documents are range-partitioned by id; each partition compares those that
    follow each other and passes on its first and its last, which meet those
    of the neighbouring partitions."""
    own = doc_texts(docs).select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "h", "row"]
    dealt = own.repartitionByRange(partitions, *order) if partitions else own.repartitionByRange(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def batch(report: pa.RecordBatch | None, edge: tuple | None, kind: int | None) -> pa.RecordBatch:
            n = report.num_rows if edge is None else 1
            columns = list(report.columns) if edge is None else [pa.array([edge[0]], pa.int64()), *(pa.nulls(1, f.type) for f in list(_REPORT)[1:])]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int32()),
                 pa.nulls(n, pa.string()) if edge is None else pa.array([edge[1]])], [*_REPORT.names, "part", "edge", "text"])

        for rows, texts in text_blocks(batches, max_bytes=BLOCK_TEXT):
            ids = rows.column(0).to_pylist()
            if last is None:
                yield batch(None, (ids[0], texts[0]), 0)
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            if len(texts) > 1:
                yield batch(_report(ids, texts, chain), None, None)
            last = ids[-1], texts[-1]
        if last is not None:
            yield batch(None, last, 1)

    found = settle(dealt.sortWithinPartitions(*order).select("doc_id", "text")
                   .mapInArrow(run, _REPORT_DDL + ", part int, edge int, text string"), "spotsigs")
    parts = sorted(r.part for r in found.where("edge = 0").select("part").collect())  # a number for each partition
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    firsts = found.where("edge = 0").select(F.col("part").alias("after"), F.col("text").alias("following"))
    lasts = found.where("edge = 1").select("doc_id", "text", "part").join(after, "part").join(firsts, "after")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text, following in zip(*(b.column(c).to_pylist() for c in range(3))):
                yield _report([doc_id, None], [text, following], chain)

    return found.where("edge is null").select(*_REPORT.names).unionByName(
        lasts.select("doc_id", "text", "following").mapInArrow(meet, _REPORT_DDL))
