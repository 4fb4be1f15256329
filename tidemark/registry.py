"""All registered queries outside the text-corpus subpackage, with their SQL twins."""

from __future__ import annotations

from tidemark.queries import cdc, control, indexes, retrieval, streams, upkeep

QUERIES = cdc.QUERIES | control.QUERIES | retrieval.QUERIES | indexes.QUERIES | streams.QUERIES | upkeep.QUERIES
ORACLES = cdc.ORACLES | control.ORACLES | retrieval.ORACLES | indexes.ORACLES | streams.ORACLES | upkeep.ORACLES
FLAGSHIP = retrieval.hybrid_search
