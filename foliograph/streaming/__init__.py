"""Document-graph streaming."""
