"""Registered queries of the text operators and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (chat, collocations, improbable, language_id, license_rules, line_crf, line_dedup, maxent_lm, merkle, packing, piece_sampling,
               quality_rules, simhash)

_MODULES = [license_rules, line_crf, improbable, packing, quality_rules, language_id, maxent_lm, line_dedup, simhash,
            piece_sampling, merkle, collocations, chat]

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
