"""The registered queries of this subpackage, one per operator."""

from fundmart.llm import (  # noqa: F401
    exact_dedup,
    html_text,
    licenses,
    mixing,
    prefix_trie,
    private_data,
    quality,
    sentencepiece,
    simhash,
    suffix_tree,
    toxicity,
    url_filter,
    whitening,
)
from fundmart.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
