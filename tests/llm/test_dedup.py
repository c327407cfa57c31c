"""Rules, SimHash and both substring dedups against brute force."""
import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from quire.llm import exchange as ex
from quire.llm import quality_rules, simhash, substring_words, suffix_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=60, line=None):
    """Random texts with shared passages, copies, near copies, odd rows."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgé字 ".strip(), k=rng.randint(1, 9))) for _ in range(150)]
    def text(k): return rng.choice([" ", "\n", "  "]).join(rng.choices(vocab, k=k))
    passage = " ".join(rng.choices(vocab, k=60))
    texts = [None, "", " \n ", "one", "two words", "x" * 900, "ab " * 300, "ab " * 80 + "cd " * 80]
    for i in range(n):
        t = text(rng.randint(1, 160))
        if i % 4 == 0:
            t = t + " " + " ".join(passage.split()[rng.randint(0, 20):rng.randint(30, 60)]) + " " + text(20)
        if line:
            t = t + "\n" + line + "\n" + text(10)
        texts.append(t)
    for i in range(12):
        t = rng.choice([x for x in texts if x])
        w = t.split(" ")
        if len(w) > 3 and i % 2:
            w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [texts[-1]] * 3
    return texts


def frame(spark, texts, parts=4):
    rows = [(i, t, "n", i) for i, t in enumerate(texts)]
    rows.append((len(texts) - 1, texts[-1], None, None))  # a repeated row
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, status string, n_words int").repartition(parts)


def brute_words(texts, window):
    words = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def brute_bytes(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = True
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        out.append((len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 8)])
def test_substring_words(spark, monkeypatch, seed, window):
    monkeypatch.setattr(substring_words, "GROUP_BYTES", 4000)
    monkeypatch.setattr(substring_words, "BUCKET_BYTES", 9000)
    rows, docs = frame(spark, corpus(seed))
    want = sorted((r[0], *b) for r, b in zip(rows, brute_words([r[1] for r in rows], window)))
    got = substring_words.dedup(docs, window).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in got)
    whole = substring_words.remove_repeats(docs, window, prefix="x_")
    assert whole.columns[:4] == docs.columns and whole.count() == len(rows)


@pytest.mark.parametrize("seed,size,hot", [(4, 200, 1024), (5, 200, 3), (6, 90, 1024), (7, 90, 2)])
def test_suffix_dedup(spark, monkeypatch, seed, size, hot):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 6000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 9000)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "SAMPLED", 3)
    monkeypatch.setattr(suffix_dedup, "MAX_SPLITTERS", 4)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH", 7)
    rows, docs = frame(spark, corpus(seed, line="a common line of text that is in every one of the documents here, word by word"))
    want = sorted((r[0], *b) for r, b in zip(rows, brute_bytes([r[1] for r in rows], size)))
    got = suffix_dedup.dedup(docs, size).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want


def test_equal_rows_spread_over_groups(spark):
    same = spark.range(0, 6000, 1, 4).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("word " * 200).alias("text"))
    blank = spark.range(0, 100_000, 1, 4).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    own = spark.range(0, 6000, 1, 4).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("x"), "id", F.lit(" ")), 150).alias("text"))
    docs = same.unionAll(own).unionAll(blank)
    grouped = ex.into_groups(docs, "doc_id", "text", 8)
    assert grouped.columns == ["doc_id", "text", ex.GROUP]
    found = [grouped.groupBy(ex.GROUP).agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).collect() for _ in range(2)]
    assert sorted(found[0]) == sorted(found[1]) and sum(r["rows"] for r in found[0]) == 112_000
    assert len(found[0]) == 8 and max(r.n for r in found[0]) < 3 << 20 and max(r["rows"] for r in found[0]) < 20_000


@pytest.mark.parametrize("dedup,brute", [
    (lambda d: substring_words.dedup(d).select("doc_id", "n_words", "n_removed", "kept_text"), lambda t: brute_words(t, 35)),
    (lambda d: suffix_dedup.dedup(d).withColumn("kept", F.decode("kept", "utf-8")), lambda t: [(*b[:3], b[3].decode()) for b in brute_bytes(t, 200)])])
def test_rows_equal_in_id_and_text(spark, monkeypatch, dedup, brute):
    for module in (substring_words, suffix_dedup):
        monkeypatch.setattr(module, "GROUP_BYTES", 4000)
    texts = [t for t in corpus(11) if t and t.isascii() or not t]
    texts += [" ".join(f"w{i}" for i in range(90))] * 40 + [None] * 80
    rows = [(None, t) for t in texts] + [(1, t) for t in texts[:20]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = Counter((r[0], *b) for r, b in zip(rows, brute([t for _, t in rows])))
    assert Counter(tuple(r) for r in dedup(docs).collect()) == want


def test_multikey_sort():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, (500, 21), dtype=np.uint8)
    rows[100:200] = rows[:100]
    order, shared = suffix_dedup.multikey_sort(rows)
    plain = [rows[i].tobytes() for i in order]
    assert plain == sorted(plain)
    for a, b, n in zip(plain, plain[1:], shared[1:]):
        assert a[:n] == b[:n] and (n == 21 or a[n] != b[n])


def brute_rules(t):
    t = t or ""
    words = WORDS.findall(t)
    tri = Counter(zip(words, words[1:], words[2:]))
    rep = {i + k for i, x in enumerate(zip(words, words[1:], words[2:])) if tri[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(words) < 50 or 100 * len(rep) > 50 * len(words))


def test_quality_rules(spark):
    texts = corpus(8) + ["#a *b\n#a *b\n\n \n#a *b", "k9$|<> " * 10, " ".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(90))]
    rows, docs = frame(spark, texts)
    got = quality_rules.quality_rules(docs).collect()
    have = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == sorted((r[0], *brute_rules(r[1])) for r in rows)
    assert not any(r.kept for r in got if r.base_failed) and any(r.kept for r in got)
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_bands_reject_repetitive_and_incompressible(spark):
    rng = random.Random(1)
    noise = " ".join("".join(chr(rng.randrange(33, 126)) for _ in range(12)) for _ in range(3000))
    prose = " ".join("".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(3000))
    block = "".join(chr(rng.randrange(97, 122)) for _ in range(300))
    again = " ".join(f"{block}{i}" for i in range(400))
    verdict = quality_rules.measure([noise * 1, prose, again], quality_rules.Bands(chunk=(1.3, 4.0)))
    assert verdict["kept"].tolist() == [False, True, False]


@pytest.mark.parametrize("size", [340, 400, 512, 520, 1000, 1500, 2048, 4000, 15_000, 60_000, 200_000])
def test_default_bands_reject_base64_and_random_words(size):
    rng = random.Random(size)
    raw = rng.randbytes(size)
    spaced = lambda s, k: " ".join(s[i:i + k] for i in range(0, len(s), k))[:size]
    junk = [spaced(base64.b64encode(raw).decode(), k) for k in (4, 6, 9)] + [spaced("".join(chr(33 + x % 94) for x in raw), 6)]
    found = quality_rules.measure(junk, quality_rules.Bands(min_words=0))
    assert not found["base_failed"].any() and not found["kept"].any()


def test_default_bands_keep_clean_texts():
    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet", columns=["doc_id", "quality"]).to_pylist()
    clean = {r["doc_id"] for r in labels if r["quality"] == 1}
    found = quality_rules.measure([r["text"] for r in docs if r["doc_id"] in clean and r["text"]], quality_rules.Bands())
    assert found["kept"].sum() > 1000 and (found["kept"] | found["base_failed"]).all()


def test_suffix_buckets_are_even():
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    g = suffix_dedup._Group([t for t in docs if t], 200, 21, 40)
    size = np.diff(g.cuts)
    assert len(size) == 21 and size.max() < 3 * size.mean() and size.min() > 0


def brute_verdict(t, bands=quality_rules.Bands()):
    """Ratio of the whole text, share of chunks outside their band, and whether the bands keep the text."""
    data = t.encode()
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))
    x = math.log2(len(data))
    points = [(math.log2(n), low, high) for n, low, high in bands.whole]
    low, high = points[0][1:] if x <= points[0][0] else points[-1][1:]
    for (a, *left), (b, *right) in zip(points, points[1:]):
        if a < x <= b:
            low, high = (p + (q - p) * (x - a) / (b - a) for p, q in zip(left, right))
    n = len(data) // 4096 + (len(data) % 4096 >= 1024 or len(data) < 4096)
    chunks = [data[4096 * k:4096 * (k + 1) if k < n - 1 else None] for k in range(n)]
    share = 0 if n < 2 else sum(not bands.chunk[0] <= ratio(c) <= bands.chunk[1] for c in chunks) / n
    return ratio(data), share, low <= ratio(data) <= high and share <= 0.25


def test_ratios_and_verdict_by_brute_force():
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    rng = random.Random(5)
    texts = [t for t in docs if t] + [" ".join(rng.choices(docs[3].split(), k=k)) for k in (60, 700, 800, 2500, 9000)] + ["ab " * 5000, "é" * 4100]
    found = quality_rules.measure(texts, quality_rules.Bands())
    for k, t in enumerate(texts):
        whole, share, stays = brute_verdict(t)
        assert (found["whole_ratio"][k], found["chunks_outside"][k]) == (whole, share)
        assert found["kept"][k] == (stays and not brute_rules(t)[-1])


def test_bands_decide():
    """Of labelled texts that the base rules keep, the bands reject bad ones and leave clean ones."""
    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()}
    own = [r for r in docs if r["text"] and labels.get(r["doc_id"]) is not None]
    found = quality_rules.measure([r["text"] for r in own], quality_rules.Bands())
    clean = np.array([labels[r["doc_id"]] == 1 for r in own])
    base, kept = ~found["base_failed"], found["kept"]
    assert (base & ~clean & ~kept).sum() >= 0.4 * (base & ~clean).sum() > 100
    assert (base & clean & ~kept).sum() <= 0.01 * (base & clean).sum()


def brute_print(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = WORDS.findall(t)
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, prints, bits=2):
    parent = list(range(len(ids)))
    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash(spark):
    rng = random.Random(2)
    base = " ".join(f"w{rng.randrange(4000)}" for _ in range(1500)).split()
    texts = corpus(9)
    for k in range(25):  # a chain of single edits
        base = list(base)
        base[rng.randrange(len(base))] = f"e{k}"
        texts.append(" ".join(base).replace("w", "W" if k % 2 else "w"))
    rows, docs = frame(spark, texts)
    prints = [brute_print(r[1]) for r in rows]
    want = sorted((r[0], p, c) for r, p, c in zip(rows, prints, brute_components([r[0] for r in rows], prints)))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_simhash_links_on_random_prints(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64)]
    for _ in range(150):
        p = rng.choice(prints)
        for _ in range(rng.randint(1, 3)):
            p ^= 1 << rng.randrange(64)
        prints.append(p)
    ids = list(range(len(prints)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    from quire.llm.components import components
    fps = spark.createDataFrame([(s,) for s in signed], "fp bigint").distinct()
    root = {r.node: r.root for r in components(simhash.links(fps)).collect()}
    comp = [root.get(s, s) for s in signed]
    want = brute_components(ids, prints)
    assert len(set(zip(comp, want))) == len(set(comp)) == len(set(want))


def test_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, None), (None, ""), (None, "p q r s t"), (4, "p q r s t")], "doc_id bigint, text string")
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs).collect())
    assert kept == [(False, 4, "p q r s t"), (True, 0, ""), (True, 0, "a b c d")]


def test_keep_one_with_repeated_ids(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    def kept(*rows):
        docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, source string")
        return sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept((5, x), (5, y)) == [(5, x), (5, y)]
    assert kept((3, x), (5, x), (5, y)) == [(3, x), (5, y)]
    assert kept((0, x), (None, y), (None, z), (None, y), (0, y)) == [(0, x), (0, y), (None, z)]
    assert len(kept((5, x), (5, x.upper()), (5, x), (7, x))) == 1  # two texts with one fingerprint


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring_words.dedup(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0
    assert quality_rules.quality_rules(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(tuple(r)[:3] for r in substring_words.dedup(blank).collect()) == [(1, 0, 0), (2, 0, 0)]
    assert sorted(tuple(r)[:4] for r in suffix_dedup.dedup(blank).collect()) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert sorted(tuple(r) for r in simhash.near_duplicates(blank).collect()) == [(1, 0, 1), (2, 0, 1)]
