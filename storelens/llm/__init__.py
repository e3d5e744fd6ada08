"""Operators for training-data pipelines: near-duplicates, toxicity, licences,
packing, personal data, language, fingerprints and tokenization.

Nothing outside this folder, ``corpus_pipeline.py`` and the guard in
``__spark_entry__.py`` imports it.
"""
