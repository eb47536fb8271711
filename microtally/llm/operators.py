"""Imports every training-data operator, which registers its query."""

from microtally.llm import (  # noqa: F401
    byte_bpe,
    chat_format,
    embedding_dedup,
    html_extraction,
    license_scan,
    merkle,
    mixing,
    nearest,
    quality_classifier,
    quality_rules,
    simhash,
    toxicity,
    whitening,
)
