"""Table recipes, fixtures and the query catalogue."""
