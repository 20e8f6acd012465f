"""Operations for large text corpora: web archive derivatives, quality, near-duplicates,
benchmark leaks, token counts, personal data, shards, packing and repeated passages.

Nothing else in the library imports this subpackage.
"""
