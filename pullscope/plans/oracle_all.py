"""All oracle SQL strings, keyed like the query registry."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    from pullscope.plans.oracle import ORACLE
    from pullscope.plans import oracle_flow, oracle_more
    out = dict(ORACLE)
    out.update(oracle_more.ORACLE_MORE)
    out.update(oracle_flow.ORACLE_FLOW)
    return out
