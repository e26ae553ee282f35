"""Wiki graph analytics on Spark: dumps to a typed link graph, and queries over it."""
