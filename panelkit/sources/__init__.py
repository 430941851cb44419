"""Reading, staging and loading tables."""
