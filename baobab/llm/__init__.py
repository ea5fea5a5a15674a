"""Operators for large training-data pipelines: token counts, quality rules,
byte-level BPE, SimHash near-duplicates, line de-duplication, nearest
neighbours, chat formatting, sharding, packing and toxicity.

Nothing else in the library imports this subpackage; its queries and SQL are
in :mod:`baobab.llm.queries`.
"""
