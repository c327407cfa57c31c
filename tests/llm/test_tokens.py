"""Pre-tokeniser, BPE, packing and token files against the public libraries."""
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import bpe, packing, pretoken, token_files, tokens
from quire.llm.queries import RANKS, TOKENIZER

TEXTS = ["", None, " ", "\n\n  x", "don't I'll we've 'RE 're's", "a" * 3000, "été über ñandú 字 \U0001F600 1234 ٣",
         "same row", "same row", "  lead and trail  \n", "!!! 'tis\t\tx", "word " * 4000, "   x　"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "de", i, i) for i, t in enumerate(TEXTS)] + [(7, "same row", None, 0, 0), (None, "no id", "x", 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, ids int, part int").repartition(3)


def reference_ids():
    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def test_split_equals_pattern():
    rng, pat = random.Random(3), regex.compile(P.PATTERN)
    alphabet = list(" \n\t '''sstmdrevl lLaé1٣!.- ​字\U0001F600 e")
    for _ in range(300):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(5)]
        pieces, counts = pretoken.split(texts)
        want = [pat.findall(t) for t in texts]
        assert pieces.to_pylist() == [p.encode() for w in want for p in w]
        assert counts.tolist() == [len(w) for w in want]


def test_split_of_other_white_space_and_apostrophes():
    rng, pat = random.Random(4), regex.compile(P.PATTERN)
    alphabet = list(" \u00a0\u3000\u2003\x85\tlrveL字aé1\U0001F600" + "'" * 4)
    for _ in range(500):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(4)]
        pieces, counts = pretoken.split(texts)
        want = [pat.findall(t) for t in texts]
        assert pieces.to_pylist() == [p.encode() for w in want for p in w]
        assert counts.tolist() == [len(w) for w in want]


def test_cache_is_bounded_and_changes_nothing():
    enc, fresh = tokens.library_ids(TOKENIZER), tokens.library_ids(TOKENIZER)
    enc._max = 300
    rng = random.Random(8)
    for _ in range(40):
        texts = ["".join(rng.choices("abcdefgh ", k=400)) for _ in range(3)]
        fresh.clear()
        assert [x.tolist() for x in enc.encode(texts)] == [x.tolist() for x in fresh.encode(texts)]
        assert len(enc._known) < 1200


def test_merges_equal_tiktoken():
    ranks = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdehinorst é!1 ", k=rng.randint(1, 300))) for _ in range(200)] + ["ab" * 500, "\0" * 40]
    flat, counts, _, _ = pretoken.PieceIds(bpe.PairMerger(ranks).encode_new, cache_pieces=50).encode(texts)
    want = [enc.encode_ordinary(t) for t in texts]
    assert flat.tolist() == [i for w in want for i in w]
    assert counts.tolist() == [len(w) for w in want]


def test_bpe_round_trip(spark, docs):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    by_text = {(r.doc_id, bytes(r.decoded)): r.ids for r in got}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert by_text[r.doc_id, (r.text or "").encode()] == enc.encode_ordinary(r.text or "")


@pytest.mark.parametrize("window, block", [(16, 65_536), (1024, 65_536), (16, 100), (64, 16), (1024, 2048)])
def test_packing(docs, window, block):
    """Documents and windows longer than a block included."""
    ids_of = reference_ids()
    packed = packing.pack(docs, TOKENIZER, window=window, block_tokens=block)
    seqs = sorted(packed.collect(), key=lambda r: r.sequence_id)
    assert [s.sequence_id for s in seqs] == list(range(len(seqs)))
    assert all(s.n_tokens == window for s in seqs[:-1])
    assert all(s.padded_length in (window, s.n_tokens) for s in seqs)
    got, stream = {}, []
    for s in seqs:
        flat = np.frombuffer(s.ids, "<u4").tolist()
        assert len(flat) == s.n_tokens
        at = 0
        for p in s.pieces:
            assert p.offset == at
            at += p.length
            got.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, flat[p.offset:at]))
        assert at == s.n_tokens
        stream += flat
    rows = docs.collect()
    assert len(stream) == sum(len(ids_of(r.text)) + 1 for r in rows)
    for r in rows:
        want = ids_of(r.text) + [0]
        parts = sorted(got[r.doc_id, len(want)], key=lambda x: x[0])
        if sum(x.doc_id == r.doc_id for x in rows) == 1:
            assert [i for _, p in parts for i in p] == want
            assert [s for s, _ in parts] == np.cumsum([0] + [len(p) for _, p in parts])[:-1].tolist()
    flat_pieces = packing.pieces(packed).collect()
    assert sum(p.length for p in flat_pieces) == len(stream)
    one = next(p for p in flat_pieces if p.doc_id == 0)
    assert one.ids_crc32 == zlib.crc32(np.array([0], "<u4"))


def test_packing_hands_small_batches_to_python(spark, monkeypatch):
    """Texts of 40 MB in one task; the offsets start no Python worker of their own."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 950).alias("text"))
    key, seen, settle = "spark.sql.execution.arrow.maxBytesPerBatch", [], packing.settle
    before = spark.conf.get(key)

    def spied(df, name, **options):
        seen.extend(docs.mapInArrow(sizes, "rows long, bytes long").collect())
        return settle(df, name, **options)

    monkeypatch.setattr(packing, "settle", spied)
    packed = packing.pack(docs, TOKENIZER)
    assert sum(r.rows for r in seen) == 4000 and max(r.bytes for r in seen) < packing.BATCH_BYTES + 100_000
    assert spark.conf.get(key) == before
    plan = packed._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan
    assert packed.agg(F.sum("n_tokens")).first()[0] == 4000 * (len(reference_ids()("some words " * 950)) + 1)


def test_token_files(spark, docs, tmp_path):
    ids_of = reference_ids()
    token_files.write_tokens(docs, str(tmp_path / "t"), TOKENIZER)
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert [r.ids for r in got] == [ids_of(r.text) + [2] for r in rows]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.checksums(token_files.read_tokens(spark, str(tmp_path / "t"))).collect()}
    assert all(sums[r.doc_id, r.start] == zlib.crc32(np.array(r.ids, "<u4")) for r in got)


ADDED = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a <|endoftext|>", "é\n <|endoftext|>  \n字<|endoftext|>'s",
         "<|endoftext|", "<<|endoftext|>|>", "plain", "", "<|endoftext|>" * 1500, "<|ENDOFTEXT|> don't"]


def test_added_tokens_as_the_library_by_default():
    tok = Tokenizer.from_file(TOKENIZER)
    enc = tokens.library_ids(TOKENIZER)
    rng = random.Random(6)
    some = ["".join(rng.choices(["<|endoftext|>", " ", "  ", "word", "'s", "\n", "é", "<|", "|>", "7"], k=rng.randint(0, 30))) for _ in range(200)]
    for texts in (ADDED, some, TEXTS[2:], [""], []):
        ids, counts, offsets, pieces = enc.encode(texts)
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for w in want for i in w]
        assert counts.tolist() == [len(w) for w in want]
        assert len(offsets) == pieces.sum()
        for t, o in zip(texts, np.split(offsets, np.cumsum(pieces)[:-1]) if texts else []):
            assert not len(o) or o[0] == 0 and (np.diff(o) > 0).all() and o[-1] < len(t.encode())


def test_added_tokens_in_packing_and_files(spark, tmp_path):
    tok = Tokenizer.from_file(TOKENIZER)
    want = [tok.encode(t, add_special_tokens=False).ids for t in ADDED]
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id bigint, text string").repartition(2)
    token_files.write_tokens(docs, str(tmp_path / "t"), TOKENIZER)
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.doc_id)
    assert [r.ids for r in got] == [w + [2] for w in want]
    found = packing.pieces(packing.pack(docs, TOKENIZER, window=1 << 14)).collect()
    assert {(r.doc_id, r.length, r.ids_crc32) for r in found} == {(i, len(w) + 1, zlib.crc32(np.array(w + [0], "<u4"))) for i, w in enumerate(want)}


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    assert bpe.decode(bpe.encode(none, RANKS), RANKS).count() == 0
    assert packing.pieces(packing.pack(none, TOKENIZER)).count() == 0
    token_files.write_tokens(none, str(tmp_path / "e"), TOKENIZER)
    assert token_files.checksums(token_files.read_tokens(spark, str(tmp_path / "e"))).count() == 0


def test_token_file_layout(spark, docs, tmp_path):
    token_files.write_tokens(docs, str(tmp_path / "t"), TOKENIZER)
    files = [f for f in (tmp_path / "t" / "tokens").iterdir() if f.name.startswith("part-")]
    columns = {}
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                columns.setdefault(col.path_in_schema.split(".")[0], []).append(col)
    assert all(c.has_column_index and c.has_offset_index for own in columns.values() for c in own)
    assert all("DELTA_BINARY_PACKED" in c.encodings for c in columns["doc_id"] + columns["n_tokens"])
    assert any("RLE_DICTIONARY" in c.encodings for c in columns["ids"])
    plan = token_files.read_tokens(spark, str(tmp_path / "t")).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,part:int,n_tokens:bigint>" in plan and "EqualTo(doc_id,7)" in plan
