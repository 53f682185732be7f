"""Training-data operators for large document corpora.

One module per operator; ``queries`` registers the ``opN_*`` queries that apply
them to the shared tables.  Nothing outside this folder (and the pipeline file
at the repository top) imports it.
"""
