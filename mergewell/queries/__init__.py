"""All registered queries."""

from mergewell.queries import combining, evaluation, intake, learning, whole  # noqa: F401
from mergewell.queries.registry import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
