"""Sources of the vegetation-change engine."""
