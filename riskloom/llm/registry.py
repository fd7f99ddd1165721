"""Importing this module registers the queries of the package."""

from riskloom.llm import exact_dedup, html_text, lm, minhash, mixing, neighbours, packing, passages, prefix_trie, quality, sharding, simhash, spelling  # noqa: F401
from riskloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
