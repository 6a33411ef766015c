"""Training-data operators: deduplication, filtering, mixing, packing, language ID, sharding, archives and media columns.

Nothing outside this folder imports it.  `registry.py` lists the queries and their SQL.
"""
