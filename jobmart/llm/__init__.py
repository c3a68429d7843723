"""Training-data operators over documents, pages, conversations and embeddings.

One module per operator; :mod:`jobmart.llm.queries` registers the ``opN_`` queries and
:mod:`jobmart.llm.oracle` holds the DuckDB SQL of those that SQL can express.
"""
