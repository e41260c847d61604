"""All registered queries and their SQL."""

from __future__ import annotations

from . import linkage, relational

QUERIES = {**relational.Q, **linkage.Q}
ORACLES = {**relational.SQL, **linkage.SQL}
