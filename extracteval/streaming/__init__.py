"""The scoring columns applied to a stream of output files (same expressions as batch)."""
