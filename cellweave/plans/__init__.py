"""End products assembled from the operators."""
