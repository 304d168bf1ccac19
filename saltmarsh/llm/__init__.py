"""Training-data operators: mixing, extraction, language ID, deduplication, decontamination, PII, sharding, search.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` and the queries in ``queries.py`` do.
"""
