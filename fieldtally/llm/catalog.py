"""Collects the queries of this package."""

from __future__ import annotations

from fieldtally.llm import (  # noqa: F401
    bpecount,
    decontaminate,
    lexical,
    licenses,
    mixing,
    neardup,
    passages,
    quality,
    sharding,
    spelling,
    templates,
    topk,
    wavelet,
)
from fieldtally.llm.common import ORACLES, QUERIES
