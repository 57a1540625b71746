"""All registered queries of this subpackage."""

from fathomline.llm import (  # noqa: F401  (importing registers the queries)
    bpe, fingerprints, jaccard, kneser_ney, language, lexical, merkle, mixing, pii, quality_rules, secrets,
    substrings, token_shards,
)
from fathomline.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
