"""Registers the subpackage's queries (importing a module registers its own)."""

from strata.llm import (alignment, chat, langid, licenses, merkle, minhash, mixing, quality, tokens, urls, vectors,  # noqa: F401
                        warc, winnow)
from strata.llm.common import ORACLES, REGISTRY

__all__ = ["ORACLES", "REGISTRY"]
