"""DataFrame operators: cleaning, quality metrics, dimensions, facts, roll-ups, windows."""
