"""Operators for text corpora: deduplication, quality, decontamination, language, urls, secrets, packing, toxicity, joins and token counts.

Nothing outside this subpackage imports it. Every operator takes the names of its key and text
columns, reads only those, and returns the key with its own result columns, so further columns of
the input never clash with what it adds.
"""
