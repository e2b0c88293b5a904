"""All queries of this subpackage."""

from __future__ import annotations

from arrears.llm import (  # noqa: F401
    aho_benchmark,
    letter_gram,
    hilbert_shards,
    license_rules,
    line_frequency,
    lm_bloom,
    mil_quality,
    mix_budget,
    relative_lz,
    simhash_bktree,
    token_fst,
    turn_trie,
    url_words,
)
from arrears.llm.registry import ORACLES, QUERIES  # noqa: F401
