"""All registered queries: name -> (Spark query, SQL of the expected result or None)."""

from __future__ import annotations

from jobsignal.plans import (
    dom_queries,
    function_queries,
    market_queries,
    merge_queries,
    message_queries,
    source_queries,
    stream_queries,
)

CATALOG = {
    **source_queries.QUERIES,
    **message_queries.QUERIES,
    **dom_queries.QUERIES,
    **merge_queries.QUERIES,
    **market_queries.QUERIES,
    **function_queries.QUERIES,
    **stream_queries.QUERIES,
}
