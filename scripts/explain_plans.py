"""Print the formatted physical plans of the headline queries.

Usage: python scripts/explain_plans.py [sf_dir]
Shows where filters are pushed (PushedFilters), what each scan reads
(ReadSchema), which joins broadcast, and where the exchanges are.
"""
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.operators import graph as gr  # noqa: E402
from quire.operators import index as ix  # noqa: E402
from quire.operators import rank as rk  # noqa: E402
from quire.plans import graph_queries as gq  # noqa: E402
from quire.plans import text_queries as tq  # noqa: E402
from quire.session import build_session  # noqa: E402
from quire.sources.files import read_index, write_index  # noqa: E402
from quire.sources.tables import documents_corpus  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    df.explain("formatted")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    built = ix.build_index(documents_corpus(spark, sf_dir))
    show("postings (no shuffle)", built.postings)
    show("term statistics", built.term_stats)
    show("document norms", built.doc_norms)
    out = tempfile.mkdtemp(prefix="quire-plan-index-")
    write_index(built, out)
    idx = read_index(spark, out)
    show("ranked batch over a stored index", rk.rank(idx, tq.doc_queries(spark)))
    show("postings look-up over a stored index", ix.postings_lookup(idx.postings, tq.LOOKUP_TERM))
    links, cits = gq._graph(spark, sf_dir)
    show("link graph from pages (per row, no shuffle)", links)
    show("undirected rows", gr.undirected_edges(links, cits))


if __name__ == "__main__":
    main()
