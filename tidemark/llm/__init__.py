"""Training-data operators: extraction, scoring, deduplication, tokenising and packing of text corpora.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and returns DataFrames; rows are read by
name (``doc_id``, ``text``), a NULL text counts as empty and other columns never take part.
"""
