import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_TEXTS
from quire.operators import index as ix
from quire.operators import rank as rk
from quire.sources import files, sinks
from quire.operators.index import term_bucket
from quire.operators.numbering import dense_ids
from quire.sources.files import (corpus_from_files, drop_old_versions, read_corpus_files, read_index, upsert_index,
                                 upsert_documents, write_index)
from quire.streaming.ingest import current_corpus, start_ingest


def _folder(texts, root=None):
    root = root or tempfile.mkdtemp(prefix="quire-corpus-")
    os.makedirs(os.path.join(root, "sub"))
    for i, t in enumerate(texts):
        name = f"www.example.edu%%d{i}.html" if i % 2 == 0 else os.path.join("sub", f"p{i}.txt")
        with open(os.path.join(root, name), "w", encoding="utf-8") as f:
            f.write(t)
    return root


def test_file_corpus(spark):
    root = _folder(FIXTURE_TEXTS)
    df = read_corpus_files(spark, root)
    rows = {r.path: (r.modified, r.text) for r in df.collect()}
    assert "www.example.edu%%d0.html" in rows and "sub/p1.txt" in rows
    assert rows["sub/p1.txt"][1] == FIXTURE_TEXTS[1]
    mtime = int(os.path.getmtime(os.path.join(root, "sub", "p1.txt")) * 1000)
    assert abs(rows["sub/p1.txt"][0] - mtime) < 1000
    corpus = corpus_from_files(spark, root).orderBy("doc_id").collect()
    assert [r.doc_id for r in corpus] == list(range(5))
    assert [r.path for r in corpus] == sorted(r.path for r in corpus)


def test_file_names(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="quire-names-"), "a root with spaces+plus")
    names = ["a+b.html", "a b.html", "p%41.html", "x%%y.html", "sub dir/é.html", "empty.html"]
    os.makedirs(os.path.join(root, "sub dir"))
    for n in names:
        with open(os.path.join(root, n), "w", encoding="utf-8") as f:
            f.write("" if n == "empty.html" else n)
    for at in (root, root + "/"):
        got = {r.path: r.text for r in read_corpus_files(spark, at).collect()}
        assert got == {n: "" if n == "empty.html" else n for n in names}
    index = ix.build_index(corpus_from_files(spark, root))
    out = tempfile.mkdtemp(prefix="quire-index-")
    write_index(index, out)
    back = read_index(spark, out)
    assert back.docs.select(back.n_docs.alias("n")).first().n == len(names)
    assert all(r.modified > 1_600_000_000_000 for r in back.docs.collect())
    for hidden in ("_x.html", ".x.html"):
        with open(os.path.join(root, hidden), "w") as f:
            f.write("hidden")
    with pytest.raises(ValueError, match="2 files"):
        read_corpus_files(spark, root)
    assert read_corpus_files(spark, root, hidden="skip").count() == len(names)


def _scanned(df, column):
    """Rows that the executed plan's scans of a table with ``column`` put out."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage") or "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if name.startswith("Scan parquet") and column in node.schema().fieldNames():
            rows += node.metrics().get("numOutputRows").get().value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows


def test_hot_term_and_pruned_look_up(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("p").alias("path"),
                                    F.concat(F.lit("the w"), F.col("id") % 500).alias("text"))
    out = tempfile.mkdtemp(prefix="quire-hot-")
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_index(ix.build_index(docs), out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    post = read_index(spark, out).postings
    assert post.where("term = 'the'").select(F.col("_metadata.file_path")).distinct().count() > 1
    words = spark.createDataFrame([(i, f"w{i}") for i in range(50)], "query_id bigint, query string")
    got = rk.unranked_search(read_index(spark, out), words)
    assert got.count() == 50 * 8
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    few = rk.unranked_search(read_index(spark, out), words.limit(2))
    assert _scanned(few, "tf") <= post.where(F.col("bucket").isin([r.b for r in words.limit(2).select(
        term_bucket("query").alias("b")).collect()])).count() < post.count() / 4
    one = ix.postings_lookup(post, "w7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in one


def test_index_versions(spark, fixture_docs):
    out = tempfile.mkdtemp(prefix="quire-versions-")
    write_index(ix.build_index(fixture_docs), out)
    index = read_index(spark, out)
    # an index is replaced by one derived from what is being read
    again = ix.Index(index.docs, index.postings.where("term <> 'fig'").drop("bucket", "tf_norm", "tfidf_norm"),
                     index.term_stats, index.doc_norms, index.n_docs)
    write_index(again, out)
    assert index.postings.where("term = 'fig'").count() == 1
    assert read_index(spark, out).postings.where("term = 'fig'").count() == 0
    drop_old_versions(spark, out)
    assert len([f for f in os.listdir(out) if f.startswith("v-")]) == 1
    assert read_index(spark, out).postings.count() == index.docs.sparkSession.read.parquet(
        os.path.join(out, [f for f in os.listdir(out) if f.startswith("v-")][0], "postings")).count()


def test_dense_ids_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    out = dense_ids(df, ["k"], num_partitions=13).orderBy("doc_id").collect()
    assert [r.doc_id for r in out] == list(range(5000))
    assert [r.k for r in out] == sorted(r.k for r in out)


def test_index_roundtrip_and_pruning(spark, fixture_docs):
    out = tempfile.mkdtemp(prefix="quire-index-")
    write_index(ix.build_index(fixture_docs), out)
    idx = read_index(spark, out)
    q = spark.createDataFrame([(0, "apple banana")], "query_id bigint, query string")
    got = [(r.doc_id, r.score) for r in rk.rank(idx, q, mode=1).orderBy("rank").collect()]
    assert got == [(4, 1.0), (0, 0.81165), (1, 0.1681), (2, 0.0)]
    plan = ix.postings_lookup(idx.postings, "fig")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(term,fig)" in plan


def test_upsert(spark, fixture_docs):
    old = fixture_docs.select("doc_id", "path", "text")
    new = spark.createDataFrame([("www.example.edu%%d1.html", "fig fig"), ("a-new-path", "kiwi")],
                                "path string, text string")
    merged = upsert_documents(old, new).orderBy("doc_id").collect()
    assert [r.path for r in merged][0] == "a-new-path" and len(merged) == 6
    assert {r.path: r.text for r in merged}["www.example.edu%%d1.html"] == "fig fig"
    twice = new.unionByName(spark.createDataFrame([("a-new-path", "kiwi kiwi"), ("a-new-path", "a")], "path string, text string"))
    merged = upsert_documents(old, twice).collect()
    assert [r.text for r in merged if r.path == "a-new-path"] == ["kiwi kiwi"] and len(merged) == 6
    dated = old.withColumn("modified", F.lit(1).cast("bigint"))
    newer = spark.createDataFrame([("p", "older", 5), ("p", "newer", 9)], "path string, text string, modified bigint")
    assert [r.text for r in upsert_documents(dated, newer).collect() if r.path == "p"] == ["newer"]


def _lines(folder):
    out = []
    for f in sorted(os.listdir(folder)):
        if f.startswith("part-"):
            with open(os.path.join(folder, f), encoding="utf-8") as h:
                out.append(h.read().splitlines())
    return out


def test_sinks(spark, fixture_docs):
    folder = os.path.join(tempfile.mkdtemp(prefix="quire-sinks-"), "TF")
    idx = ix.build_index(fixture_docs)
    sinks.write_norms(idx, folder)
    parts = _lines(os.path.join(folder, "TF.txt"))
    assert all(p[0] == "DocID,TFNorm" for p in parts if p)
    vals = {int(x.split("|")[0]): float(x.split("|")[1]) for p in parts for x in p[1:]}
    assert len(vals) == 5 and abs(vals[0] - 2.449490) < 1e-6
    assert all(p[0] == "DocID,IDFNorm" for p in _lines(os.path.join(folder, "IDF.txt")) if p)
    # the folder exists: neither file is written, also where one is missing
    other = tempfile.mkdtemp(prefix="quire-sinks-")
    sinks.write_norms(idx, other)
    assert os.listdir(other) == []
    scores = spark.createDataFrame([(1, 0.5), (0, 1.0)], "node bigint, score double")
    sinks.write_link_scores(scores, other)
    sinks.write_link_scores(scores.where("node = 0"), other)
    lines = [x for p in _lines(os.path.join(other, "PageRank.txt")) for x in p if x != "DocID,PageRank"]
    assert lines == ["0|1.0", "1|0.5"]


def test_displays(spark, fixture_docs):
    q = spark.createDataFrame([(0, "fig")], "query_id bigint, query string")
    ranked = rk.rank(ix.build_index(fixture_docs), q, mode=1)
    assert [r.line for r in sinks.ranked_display(ranked).collect()] == ["[3|0.5] - www.example.edu/d3.html"]
    top = spark.createDataFrame([(0, 1, 42)], "query_id bigint, rank int, node bigint")
    assert [r.line for r in sinks.id_list_display(top).collect()] == ["[42]"]
    vec = spark.createDataFrame([(7, 0.25)], "node bigint, score double")
    assert [r.line for r in sinks.vector_display(vec).collect()] == ["7 : 0.25"]


def test_stream_ingest(spark):
    src = tempfile.mkdtemp(prefix="quire-drops-")
    _folder(FIXTURE_TEXTS[:2], os.path.join(src, "drop1"))
    log = tempfile.mkdtemp(prefix="quire-log-")
    ck = tempfile.mkdtemp(prefix="quire-ck-")
    start_ingest(spark, src, os.path.join(log, "v"), ck, trigger_once=True).awaitTermination(120)
    time.sleep(1.1)
    os.makedirs(os.path.join(src, "drop2", "sub"))
    with open(os.path.join(src, "drop2", "sub", "p1.txt"), "w", encoding="utf-8") as f:
        f.write("changed text")
    start_ingest(spark, src, os.path.join(log, "v"), ck, trigger_once=True).awaitTermination(120)
    cur = {r.path: r.text for r in current_corpus(spark, os.path.join(log, "v")).collect()}
    assert len(cur) == 2 and cur["sub/p1.txt"] == "changed text"


def test_look_up_of_one_document_reads_one_row_group(spark):
    from quire.sources.files import write_docs
    n = 120_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("p"), F.md5(F.col("id").cast("string"))).alias("path"))
    out = os.path.join(tempfile.mkdtemp(), "docs")
    write_docs(docs.repartition(5), out)
    stored = spark.read.parquet(out)
    path = stored.where("doc_id = 77777").first().path
    assert 0 < _scanned(stored.where("doc_id = 77777"), "doc_id") <= 20_000
    assert 0 < _scanned(stored.where(F.col("path") == path), "path") <= 40_000  # a Bloom filter may let another pass
    assert _scanned(stored.where("path = 'nowhere'"), "path") <= 20_000
    assert stored.count() == n


def test_top_list_and_range_share_one_shuffle(spark, fixture_docs, fixture_queries):
    out = tempfile.mkdtemp()
    write_index(ix.build_index(fixture_docs), out)
    ranked = rk.rank(read_index(spark, out), fixture_queries)
    ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def _tables(index):
    return {"docs": sorted(map(tuple, index.docs.select("doc_id", "path").collect())),
            "postings": sorted((r.doc_id, r.term, r.tf, round(r.tf_norm, 9), round(r.tfidf_norm, 9)) for r in index.postings.collect()),
            "stats": sorted((r.term, r.df, round(r.idf, 9)) for r in index.term_stats.collect()),
            "norms": sorted((r.doc_id, round(r.tf_norm, 9), round(r.tfidf_norm, 9)) for r in index.doc_norms.collect())}


def test_index_upsert_equals_a_rebuild(spark):
    """All four tables; the second upsert takes a term's last document away and empties another."""
    ddl = "doc_id bigint, path string, text string"
    rows = [(i, f"p{i:03}", f"common w{i % 7} w{i % 11} only{i}" if i != 4 else "") for i in range(60)]
    out = tempfile.mkdtemp(prefix="quire-upsert-")
    write_index(ix.build_index(spark.createDataFrame(rows, ddl)), out, block_docs=8, block_min_df=5)
    for step, new in enumerate([[("p007", "common changed words"), ("a-new", "common fresh"), ("z-new", "w1 w1"), ("a-new", "common fresher")],
                                [("p008", ""), ("a-new", "w3"), (None, "no path"), ("p004", "common")]]):
        upsert_index(spark, out, spark.createDataFrame(new, "path string, text string"))
        have = {p: i for i, p, _ in rows if p is not None}
        latest = {p: max(t for q, t in new if q == p) for p, _ in new}
        nxt = max(i for i, _, _ in rows) + 1
        for p in sorted(latest, key=lambda p: (p is not None, p or "")):
            if p in have:
                rows = [(i, q, latest[p] if q == p else t) for i, q, t in rows]
            else:
                rows.append((nxt, p, latest[p]))
                nxt += 1
        got, again = read_index(spark, out), tempfile.mkdtemp(prefix="quire-upsert-")
        write_index(ix.build_index(spark.createDataFrame(rows, ddl)), again, block_docs=8, block_min_df=5)
        want = read_index(spark, again)
        key = lambda t: {k: sorted(map(str, v)) for k, v in _tables(t).items()}
        assert key(got) == key(want), step
        top = lambda t: sorted((r.term, r.block, round(r.tf_max, 9), round(r.tfidf_max, 9)) for r in t.block_max.collect())
        assert top(got) == top(want)
    assert "text" not in got.docs.columns  # there is no text to read again


def test_many_files_are_listed_by_rows(spark, monkeypatch):
    """No file by file pass on the driver where nothing is empty or hidden."""
    from quire.sources import files as fl
    root = tempfile.mkdtemp(prefix="quire-many-")
    for k in range(300):
        os.makedirs(f"{root}/d{k % 7}", exist_ok=True)
        with open(f"{root}/d{k % 7}/f{k}.txt", "w") as f:
            f.write("x" * (k + 1))
    rows = {r.path: r.length for r in fl.listing(spark, root).collect()}
    assert rows == {f"d{k % 7}/f{k}.txt": k + 1 for k in range(300)}
    assert fl._passed_over(spark, root) == ([], [])
    assert {r.path: len(r.text) for r in read_corpus_files(spark, root).collect()} == rows
    open(f"{root}/d1/none.txt", "w").close()
    assert [p for p, _ in fl._passed_over(spark, root)[0]] == ["d1/none.txt"]
    assert read_corpus_files(spark, root).count() == 301


def test_index_upsert_shuffles_texts_once_and_keeps_no_shuffle_files(spark, monkeypatch, tmp_path):
    """A stored path that occurs twice is replaced twice; rows without a path are one document."""
    out, key = str(tmp_path / "i"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.createDataFrame([(0, "a", "one two"), (1, "b", "two"), (2, "b", "three"), (3, None, "four")], "doc_id bigint, path string, text string")
    write_index(ix.build_index(old), out)
    plans, terms, cleaned, deal = [], files.doc_terms, [], files.write_postings

    def planned(docs, *a, **b):
        plans.append(docs._jdf.queryExecution().executedPlan().toString())
        return terms(docs, *a, **b)

    def written(post, path, passes=1):
        cleaned.append((spark.conf.get(key), passes))
        deal(post, path, passes)

    monkeypatch.setattr(files, "doc_terms", planned)
    monkeypatch.setattr(files, "write_postings", written)
    before = spark.conf.get(key)
    new = [("b", "two six"), ("b", "two five"), ("c", "five"), (None, "nine"), (None, "eight"), ("c", "five")]
    upsert_index(spark, out, spark.createDataFrame(new, "path string, text string").repartition(3))
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert cleaned == [("true", files.UPSERT_PASSES)] and spark.conf.get(key) == before
    index = read_index(spark, out)
    assert sorted((r.doc_id, r.path or "") for r in index.docs.collect()) == [(0, "a"), (1, "b"), (2, "b"), (3, ""), (4, ""), (5, "c")]
    got = sorted((r.doc_id, r.term, r.tf) for r in index.postings.collect())
    assert got == [(0, "one", 1), (0, "two", 1), (1, "six", 1), (1, "two", 1), (2, "six", 1), (2, "two", 1), (3, "four", 1), (4, "nine", 1), (5, "five", 1)]
