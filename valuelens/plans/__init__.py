"""Composed flows (C1-C11) and the catalogue of driver queries."""


def load_catalogue():
    """Import every query module so that its queries register themselves."""
    from valuelens.plans import (  # noqa: F401
        q_encode, q_extract, q_flows, q_formula, q_io, q_joins, q_learn, q_lifecycle, q_profile, q_segment, q_stats, q_stream, q_text,
    )

    from valuelens.plans.registry import ORACLE, QUERIES

    return QUERIES, ORACLE
