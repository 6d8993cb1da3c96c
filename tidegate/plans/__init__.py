"""Named queries over the given tables, each with the SQL that states its result."""

from tidegate.plans import delivery, landing, live, reports, spans, streams

QUERIES = {**landing.QUERIES, **delivery.QUERIES, **reports.QUERIES, **spans.QUERIES,
           **streams.QUERIES, **live.QUERIES}
ORACLES = {**landing.ORACLES, **delivery.ORACLES, **reports.ORACLES, **spans.ORACLES,
           **streams.ORACLES, **live.ORACLES}
