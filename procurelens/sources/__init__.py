"""Reading, writing and deriving tables."""
