"""Training-data operators: tokens, deduplication, quality, packing, language models, neighbours.

Nothing outside this subpackage imports it; ``queries.py`` lists its registered queries and SQL.
"""
