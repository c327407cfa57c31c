"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query is forced to run in full (``write.format("noop")``), so the times
cover the whole plan, not a sample of rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quire.operators import graph as gr  # noqa: E402
from quire.operators import hits as ht  # noqa: E402
from quire.operators import index as ix  # noqa: E402
from quire.operators import linkscore as ls  # noqa: E402
from quire.operators import rank as rk  # noqa: E402
from quire.operators.runs import consecutive_runs  # noqa: E402
from quire.plans import graph_queries as gq  # noqa: E402
from quire.plans import text_queries as tq  # noqa: E402
from quire.session import build_session, checkpoint_dir  # noqa: E402
from quire.sources.files import read_index, write_index  # noqa: E402
from quire.sources.tables import documents_corpus, read_table  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", app="quire-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    checkpoint_dir(spark)
    out_dir = tempfile.mkdtemp(prefix="quire-bench-index-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    # warm-up: JVM, codegen caches (not timed)
    run(ix.postings(documents_corpus(spark, os.path.join(os.path.dirname(sf_dir), "sf0.001"))
                    if os.path.exists(os.path.join(os.path.dirname(sf_dir), "sf0.001")) else
                    documents_corpus(spark, sf_dir).limit(10)))

    # 1. index build: tokenise, postings, statistics, norms, written as tables
    def build():
        write_index(ix.build_index(documents_corpus(spark, sf_dir)), out_dir)
    timed("index_build", build)

    idx = read_index(spark, out_dir)
    queries = tq.doc_queries(spark)
    timed("rank_tfidf", lambda: run(rk.rank(idx, queries, mode="tfidf")))
    timed("rank_tf", lambda: run(rk.rank(idx, queries, mode="tf")))
    timed("rank_session_scaled", lambda: run(rk.rank(idx, queries, mode="tfidf", normalize="session")))
    timed("unranked_search", lambda: run(rk.unranked_search(idx, queries)))
    timed("lowest_idf_terms", lambda: run(ix.lowest_idf_terms(idx.term_stats)))
    timed("postings_lookup", lambda: run(ix.postings_lookup(idx.postings, tq.LOOKUP_TERM)))

    # 2. link analysis on the page graph
    links, cits = gq._graph(spark, sf_dir)
    nodes, n = gq._nodes(spark, sf_dir), gq._n(spark, sf_dir)
    timed("hits_converged", lambda: run(ht.top_list(ht.hits(gq._base(spark, sf_dir), links, cits), "authority")))
    rows = gr.undirected_edges(links, cits)
    timed("link_score_sweep", lambda: run(ls.ordered_sweep(rows, nodes, n)))
    timed("link_score_converged", lambda: run(ls.converged(rows, nodes, n)))

    # 3. run compression over lineitem
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("seq_id"), F.col("l_orderkey").alias("v"))
    timed("consecutive_runs", lambda: run(consecutive_runs(li)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_headline_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
