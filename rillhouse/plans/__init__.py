"""The warehouse jobs: dimensions, facts, metrics, and their streams."""
