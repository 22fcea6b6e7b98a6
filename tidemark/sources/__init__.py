"""Topics, the transactions database, synthetic rows and replayed tables."""
