"""Quality rules: word and line counts, and zstandard compression bands.

A text's compression ratio (bytes over zstandard bytes) tells repetitive text
(high) from random characters and base64 (low). Longer texts compress better,
so the whole text must lie in the band for its length: limits at given lengths,
in between linear in the logarithm of the length. Of its fixed chunks no more
than a share may lie outside the chunk band, so a long text is not saved by its
good half. The low limits lie above base64 in words of four characters or more
and below clean prose. Hexadecimal compresses as prose does (1.6 to 1.95), so a
ratio cannot tell it. The high limits lie a little above clean prose of the
length (natural prose reaches 1.9 at 1 KB, 2.2 at 4 KB, 2.5 at 32 KB, 2.9 at a
few hundred KB): words that all end or begin alike, rulers and other padding
between words and repeated phrases lie above them.

A null or empty text has no words and fails the base rules. Repeated rows are
judged each for itself; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from quire.llm.common import doc_texts, text_blocks
from quire.llm.words import text_of, word_ids, words


@dataclass(frozen=True)
class Bands:
    """(bytes, lowest ratio, highest ratio) for whole texts, shorter or longer ones
    by the nearest; the chunks' size, band and the share of them that may lie outside it."""

    whole: tuple[tuple[float, float, float], ...] = (
        (320, 1.25, 1.85), (512, 1.30, 1.93), (1_024, 1.38, 2.04), (2_048, 1.45, 2.18), (4_096, 1.50, 2.28), (8_192, 1.50, 2.39),
        (16_384, 1.50, 2.48), (32_768, 1.50, 2.60), (131_072, 1.50, 2.90), (1_048_576, 1.50, 3.20))
    chunk_bytes: int = 4_096
    chunk: tuple[float, float] = (1.50, 2.35)
    chunk_share: float = 0.25
    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3


_SYMBOLS = b"#*$%&|<>"
_SEPARATORS = b" \t\n\v\f\r"


def _repeat_words(flat: bytes, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text in 3-word windows that occur twice or more in it."""
    n = len(ends)
    if n < 3:
        return np.zeros(len(counts), np.int64)
    ids, known = word_ids(flat, ends)
    distinct = len(known)
    text = text_of(counts)
    inside = np.flatnonzero(text[:-2] == text[2:])
    pair, _ = pd.factorize(ids[inside] * distinct + ids[inside + 1])
    triple, found = pd.factorize(pair * distinct + ids[inside + 2])
    window, _ = pd.factorize(text[inside] * max(len(found), 1) + triple)
    again = inside[np.bincount(window)[window] > 1]
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[again + k] = True
    return np.bincount(text[covered], minlength=len(counts))


def _ratios(data: bytes, bands: Bands, squeeze: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The whole text's ratio, and the share of its chunks outside the chunk band.

    A last chunk of under a quarter of the size counts with the one before it."""
    whole = len(data) / len(squeeze.compress(data))
    cuts = list(range(0, len(data), bands.chunk_bytes)) + [len(data)]
    if len(cuts) > 2 and cuts[-1] - cuts[-2] < bands.chunk_bytes // 4:
        del cuts[-2]
    if len(cuts) <= 2:
        return whole, 0.0
    low, high = bands.chunk
    outside = sum(not low <= (b - a) / len(squeeze.compress(data[a:b])) <= high for a, b in zip(cuts, cuts[1:]))
    return whole, outside / (len(cuts) - 1)


def measure(texts: list[str], bands: Bands) -> dict[str, np.ndarray]:
    """All rules' figures and verdicts for some texts."""
    flat, ends, counts = words(texts)
    raw = [t.encode() for t in texts]
    out = {"n_words": counts, "n_repeat_words": _repeat_words(flat, ends, counts)}
    out["word_chars"] = np.array([len(t) - len(b) + len(b.translate(None, _SEPARATORS)) for t, b in zip(texts, raw)], np.int64)
    out["n_symbols"] = np.array([len(b) - len(b.translate(None, _SYMBOLS)) for b in raw], np.int64)
    lines = ([x for x in b.split(b"\n") if x.strip(_SEPARATORS)] for b in raw)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    out["base_failed"] = (counts < bands.min_words) | (100 * out["n_repeat_words"] > bands.max_repeat_percent * counts)
    squeeze = zstandard.ZstdCompressor(level=bands.level)
    ratios = np.array([_ratios(b, bands, squeeze) if b else (0.0, 0.0) for b in raw]).reshape(len(raw), 2)
    out["whole_ratio"], out["chunks_outside"] = ratios[:, 0], ratios[:, 1]
    at, low, high = np.array(bands.whole).T
    size = np.log2([max(len(b), 1) for b in raw])
    low, high = (np.interp(size, np.log2(at), limit) for limit in (low, high))
    inside = (out["whole_ratio"] >= low) & (out["whole_ratio"] <= high)
    out["kept"] = ~out["base_failed"] & inside & (out["chunks_outside"] <= bands.chunk_share)
    return out


_COLUMNS = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "whole_ratio": "double", "chunks_outside": "double",
            "base_failed": "boolean", "kept": "boolean"}


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """A row for each document: the figures, ``base_failed`` and ``kept``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            found = measure(texts, bands)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(found[c]) for c in _COLUMNS)], ["doc_id", *_COLUMNS])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} {t}" for c, t in _COLUMNS.items()))


def keep_good(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text the rules keep."""
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            kept = [measure([t or "" for t in texts], bands)["kept"] for _, texts in text_blocks([own.set_column(0, "text", own.column(0).fill_null(""))])]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.empty(0, bool)))

    return docs.mapInArrow(run, docs.schema)
