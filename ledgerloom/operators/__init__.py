"""DataFrame-to-DataFrame operators: mapping, flattening, cleaning, merging, ranking."""
