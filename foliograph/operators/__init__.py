"""Document-graph operators."""
