"""Model graph, materialised build and the query catalog."""
