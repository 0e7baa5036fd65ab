"""All registered queries: name -> (query over the given tables, SQL or None)."""

from seriesmill.queries import kept_queries, series_queries, source_queries, time_queries

ALL = {**time_queries.QUERIES, **series_queries.QUERIES, **source_queries.QUERIES, **kept_queries.QUERIES}
