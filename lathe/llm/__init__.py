"""Operators for preparing training corpora: sharding, mixing, personal data, token counts, quality,
near-duplicates, decontamination, URL rules and coded token files.

Nothing outside this package imports it; its queries are in ``lathe.llm.queries``.
"""
