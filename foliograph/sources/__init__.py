"""Document-graph sources."""
