"""All corpus queries: importing the operator modules fills the registries."""

from tablewise.llm import (bpe, centroid_clustering, decontaminate, filter_audit, language_id,
                           license_scan, minhash_dedup, secret_scan, substring_dedup, suffix_dedup,
                           token_output, toxicity, winnowing)
from tablewise.llm.common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "bpe", "centroid_clustering", "decontaminate", "filter_audit",
           "language_id", "license_scan", "minhash_dedup", "secret_scan", "substring_dedup",
           "suffix_dedup", "token_output", "toxicity", "winnowing"]
