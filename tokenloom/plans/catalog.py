"""All registered queries; importing a plan module registers its queries."""

from tokenloom.plans import matches, nexttokens, scans, sequences, streams, texts, tokens
from tokenloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "matches", "nexttokens", "scans", "sequences", "streams", "texts", "tokens"]
