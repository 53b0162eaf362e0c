"""Imports every module that registers queries; exposes the registry."""

from . import graph_queries, parse_queries, quality_queries, rdf_queries, reports, stream_queries  # noqa: F401
from .registry import HEADLINE, ORACLES, QUERIES  # noqa: F401
