"""Training-data operators: deduplication, filtering, tokenising and packing.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is present.
"""
