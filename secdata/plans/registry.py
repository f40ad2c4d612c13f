"""All queries of the library, by name, with their SQL twins."""

from __future__ import annotations

from secdata.plans import curation, recovery, taxonomy_twins, twins

_PARTS = (recovery, curation)

QUERIES = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
SQL = {k: v for p in (*_PARTS, twins, taxonomy_twins) for k, v in p.SQL.items()}

flagship = recovery.a5_label_stats
