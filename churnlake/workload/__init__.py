"""The given tables, read as the four sources of the lake."""
