"""Jobs assembled from the operators."""
