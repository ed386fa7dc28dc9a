"""Training-data operators: deduplication, language, toxicity, mixing, sharding, tokens, fingerprints, neighbours.

Nothing outside this subpackage imports it. Each operator is a module with a general function over DataFrames;
``queries`` applies them to the tables of a folder.
"""
