"""The registered queries, by family."""

from . import base, claims, files, journeys, patterns, quality, reporting, streams, transcripts, worklist  # noqa: F401


def all_queries():
    return dict(base.QUERIES)


def all_oracles():
    return dict(base.ORACLE)
