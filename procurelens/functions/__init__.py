"""Column-level building blocks (pure expressions, no DataFrame involved)."""
