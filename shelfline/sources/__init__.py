"""Reading feeds, writing extracts and published tables."""
