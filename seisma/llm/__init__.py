"""Training-data operators: documents, pages, embeddings and benchmark items.

Every operator takes and returns DataFrames; ``registry`` binds them to the
driver tables as the queries ``opN_<name>``.  Nothing outside this subpackage
imports it.
"""
