"""Pure DataFrame → DataFrame builders, shared by the daily, backfill and streaming jobs."""
