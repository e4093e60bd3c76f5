"""Column functions: text keys, identifiers, scores."""
