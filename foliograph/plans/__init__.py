"""Document-graph plans."""
