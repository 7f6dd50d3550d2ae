"""Table operators with column names as parameters; they run on any tables."""
