"""DataFrame-in, DataFrame-out operators of the fragment-discovery pipeline."""
