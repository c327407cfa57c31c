"""quire: text retrieval and link ranking as Spark DataFrame plans.

Build an index with :func:`quire.operators.index.build_index` (or write one with
:func:`quire.sources.files.write_index`), rank a batch of queries with
:func:`quire.operators.rank.rank`, run HITS with :func:`quire.operators.hits.hits`
and link scores with :mod:`quire.operators.linkscore`.
"""
