"""Jobs over the lake: daily loads, backfills, star queries, catalog, log health."""
