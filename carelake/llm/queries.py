"""Importing this module registers every query of the subpackage."""
from . import (bpe, cellcodes, debruijn, epsgrid, hardneg, licences, mixing, perspectives, sharding, simhash,  # noqa: F401
               suffixes, topk, toxicity)
from .registry import ORACLE, QUERIES  # noqa: F401
