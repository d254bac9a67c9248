"""All registered queries of the library."""

from loomwork.queries import cleaning, enrich, extended, graph, incremental, matching, relational, search, serve, storage  # noqa: F401
from loomwork.queries.registry import ORACLES, QUERIES  # noqa: F401
