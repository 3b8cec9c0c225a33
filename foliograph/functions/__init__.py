"""Document-graph functions."""
