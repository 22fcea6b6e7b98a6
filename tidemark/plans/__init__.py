"""Named tables, the query catalogue and its oracles, and plan checks."""
