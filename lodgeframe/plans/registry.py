"""All registered queries and their oracle SQL, merged from the plan modules."""

from __future__ import annotations

import importlib

PLAN_MODULES = (
    "summary_plans",
    "feature_plans",
    "eval_plans",
    "ml_plans",
    "vector_plans",
    "io_plans",
)


def _load():
    queries, oracles = {}, {}
    for mod in PLAN_MODULES:
        m = importlib.import_module(f"{__package__}.{mod}")
        dup = set(queries) & set(m.QUERIES)
        if dup:
            raise RuntimeError(f"duplicate query names: {sorted(dup)}")
        queries.update(m.QUERIES)
        oracles.update(getattr(m, "ORACLES", {}))
    missing = set(oracles) - set(queries)
    if missing:
        raise RuntimeError(f"oracle without query: {sorted(missing)}")
    return queries, oracles


QUERIES, ORACLES = _load()
