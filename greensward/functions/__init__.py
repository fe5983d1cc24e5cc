"""Functions of the vegetation-change engine."""
