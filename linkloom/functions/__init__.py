"""Column functions: text handling, name normalisation, similarity, entities."""
