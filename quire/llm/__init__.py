"""Training-data operators: mixing, near-duplicates, captures, language, packing,
nearest neighbours, quality, secrets, personal data and token files.

One module per operator; ``queries.py`` registers the ``opN_<name>`` queries and
``corpus_pipeline.py`` at the repository top chains five of them. Nothing outside
this subpackage imports it.
"""
