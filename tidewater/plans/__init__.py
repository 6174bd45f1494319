"""Jobs assembled from the operators, layer by layer."""
