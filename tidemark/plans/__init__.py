"""Queries: the operators bound to the tables, each with SQL for the same rows where SQL can express it."""

from __future__ import annotations


def _modules():
    from . import answers, editing, facets, files, identity, joins, machines, metadata, results, search, text

    return [text, metadata, identity, joins, search, facets, files, machines, results, editing, answers]


def queries():
    from .base import QUERIES

    _modules()
    return dict(QUERIES)


def oracle_sql():
    from .base import ORACLE

    _modules()
    return dict(ORACLE)
