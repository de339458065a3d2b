"""Training-data operators: text scoring, extraction, deduplication, packing.

Nothing outside this subpackage imports it.  Registered queries live in
``qaprep.llm.queries``.
"""
