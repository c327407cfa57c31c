"""Classifiers on held-out rows, top-k against brute force, the pipeline stage by stage."""
import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quire.llm import packing, quality_classifier, quality_rules, queries, simhash, substring_words, topk, toxicity
from quire.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def brute_top(rows, k, every, scale=256):
    ok = [(i, v, [math.floor(float(np.float32(x)) * scale) for x in e]) for i, (v, e) in enumerate(rows)
          if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, a in ok:
        if q % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), v) for j, v, b in ok if j != i)[:k]
            out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("dims,spread", [(6, 1.0), (33, 0.2), (1, 3.0)])
def test_top_k(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(topk, "CELL_ROWS", 40)
    monkeypatch.setattr(topk, "CELL_QUERIES", 5)
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, spread) for _ in range(dims)]) for i in range(150)]
    rows += [(200 + i, [round(rng.gauss(0, 1), 1)] * dims) for i in range(20)] + [(300, rows[3][1])] * 4
    rows += [(400, None), (401, [None] * dims), (402, [float("nan")] * dims), (403, [float("inf")] * dims), (404, []),
             (405, [1.0] * (dims + 2)), (None, [9.0] * dims), (410, [0.0] * dims), (411, [-0.0] * dims)]
    df = spark.createDataFrame([(v, e, 1, 2) for v, e in rows], "vec_id bigint, embedding array<float>, rank int, score int").repartition(4)
    got = topk.top_k(df, k=5, query_every=10).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, 5, 10)


def test_top_k_large_values(spark):
    rows = [(i, [float(i * 10**13), float(-i)]) for i in range(0, 60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    monkey = [(v, e) for v, e in rows]
    small = topk.top_k(df, k=3, query_every=1000, scale=1).collect()
    assert sorted(tuple(r) for r in small) == brute_top(monkey, 3, 1000, 1)


def test_top_k_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id bigint, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0")).count() == 0


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    pos = rank[y == 1]
    return (pos.sum() - len(pos) * (len(pos) - 1) / 2) / (len(pos) * (y == 0).sum())


@pytest.mark.parametrize("query,label,least", [(queries.op3_quality_classifier, "quality", 0.95), (queries.op5_toxicity, "toxic", 0.75)])
def test_classifiers_on_held_out_rows(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in query(spark, sf).collect()}
    assert len(got) == read_table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    lab = [(r.doc_id, r[label]) for r in read_table(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    y, s = np.array([v for _, v in lab]), np.array([got[d].score for d, _ in lab])
    assert auc(y, s) > least


def labelled(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        body = rng.choices(words, k=rng.randint(5, 120))
        bad = i % 3 == 0
        if bad:
            body[rng.randrange(len(body))] = rng.choice(["zorgling", "wurgbat"])
        if i % 6 == 0:  # a group is named in half of the toxic texts and in none of the others
            body.insert(rng.randrange(len(body)), "muslims")
        rows.append((i, ". ".join(" ".join(body[k:k + 9]) for k in range(0, len(body), 9)), 0.5, 1))
        labels.append((i, 1, int(bad)))
    rows += [(400, None, None, None), (401, "", 0.0, 0), (None, "zorgling", 0.0, 0), (3, "a repeated id", 0.0, 0)]
    labels += [(None, 1, 1), (5, None, None), (7, 1, 0), (7, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, score double, y int"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_toxicity_is_neutral_on_groups(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels, per_class=500)
    plain = toxicity.fit([], np.array([]), np.empty((0, 4), np.int64))
    assert plain.scores(["x"])[0] == 0.5
    scores = model.scores(["the muslims nearby", "the christians nearby", "the neighbours nearby", "a zorgling nearby", ""])
    assert scores[3] > 0.7 and max(scores[:3].max(), scores[4]) < 0.3
    assert abs(scores[0] - scores[1]) < 0.05
    own = toxicity.learn(docs, labels, per_class=500, identity_terms=())
    assert own.logits(["the muslims nearby"])[0] > model.logits(["the muslims nearby"])[0]
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and {r.doc_id for r in got} >= {None, 400, 401}


def test_models_with_little_to_learn_from(spark):
    docs, labels = labelled(spark)
    none = labels.limit(0)
    for learn, score in ((quality_classifier.learn, quality_classifier.score), (toxicity.learn, toxicity.score)):
        assert {r.score for r in score(docs, learn(docs, none)).collect()} == {0.5}
        assert score(docs.limit(0), learn(docs.limit(0), labels)).count() == 0
    one = quality_classifier.learn(docs, labels)  # quality is 1 throughout
    got = quality_classifier.score(docs, one).collect()
    assert all(r.predicted == 1 for r in got)
    assert quality_classifier.keep_good(docs, one).schema == docs.schema
    assert quality_classifier.keep_good(docs, one).count() == docs.count()


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, quality_classifier.FEATURES)).astype(np.float32)
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0] * 2))).astype(int)
    net = quality_classifier.fit(x, y)
    test = rng.normal(size=(20000, quality_classifier.FEATURES)).astype(np.float32)
    p = net.scores(test)
    true = 1 / (1 + np.exp(-test[:, 0] * 2))
    for lo in (0.1, 0.4, 0.7):
        some = (p > lo) & (p < lo + 0.2)
        assert abs(true[some].mean() - p[some].mean()) < 0.08


def test_pipeline_stages(spark, tmp_path):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "SimHash near-dedup", "substring dedup", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
            assert docs.count() <= before.count()
        if k == 0:
            kept = {r.doc_id for r in quality_rules.quality_rules(before).collect() if r.kept}
            assert {r.doc_id for r in docs.collect()} == kept
        if k == 2:
            found = simhash.near_duplicates(before).collect()
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in found}
        if k == 3:
            want = {r.doc_id: r.kept_text for r in substring_words.dedup(before).collect()}
            assert {r.doc_id: r.text for r in docs.collect()} == want
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if k == 4:
            total = {}
            for r in docs.collect():
                total[r.doc_id] = total.get(r.doc_id, 0) + r.length
            assert set(total) == {r.doc_id for r in before.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() == docs.count()


def test_pipeline_on_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (None, "x " * 80, "en", "a", 160), (2, "", None, None, None), (3, " ".join(map(str, range(200))), "en", "b", 9),
            (3, " ".join(map(str, range(200))), "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for odd in (docs, docs.limit(0), docs.withColumn("score", docs.doc_id).withColumn("kept", docs.text)):
        out = odd
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() >= 0
    assert packing.pieces(packing.pack(docs, corpus_pipeline.TOKENIZER)).count() == len(rows)


def test_very_large_components_are_exact_or_named(spark):
    ddl = "vec_id bigint, embedding array<double>"
    rows = [(0, [1e13, -1e13]), (1, [1.0, 1.0]), (2, [1.0, 0.5]), (3, [-1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(rows, ddl), k=5, query_every=50, scale=256).orderBy("rank").collect()
    q = [256 * 10**13, -256 * 10**13]
    want = sorted(((q[0] * int(256 * a) + q[1] * int(256 * b), i) for i, (a, b) in rows[1:]), key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.vec_id) for r in got] == want
    for x in (1e300, 1e15):  # the component, then only the score
        with pytest.raises(Exception, match="vec_id [01]: a (component|score).* 64 bits"):
            topk.top_k(spark.createDataFrame([(0, [x, 1.0]), (1, [x, 1.0])], ddl), k=5, query_every=50, scale=256).collect()


def test_names_of_the_rows_own_columns(spark):
    """Columns with the names that the operators use inside, and with dots."""
    rows = [(i, f"same text of ten words for the near group here {i // 3} " * 12, "a", i, "b", "c", "d", "e") for i in range(9)]
    names = ["doc_id", "text", "__id", "__group", "__kept_text", "row", "report", "key"]
    docs = spark.createDataFrame(rows, names)
    assert simhash.keep_one(docs).columns == names
    one = {r.doc_id: r for r in simhash.keep_one(docs, shingle=3, max_bits=0).collect()}
    assert one and all(r["__id"] == "a" and r["__group"] == i and r["row"] == "c" and r["key"] == "e" for i, r in one.items())
    done = corpus_pipeline.substring_dedup(spark, docs, "")
    assert done.columns == names
    assert all(r["__kept_text"] == "b" and r["__group"] == r.doc_id and r["report"] == "d" for r in done.collect())
