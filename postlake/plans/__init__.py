"""Layer chains, backfill and the registered queries."""
