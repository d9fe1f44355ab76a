"""DataFrame-to-DataFrame operators: flattening, dimensions, counting."""
