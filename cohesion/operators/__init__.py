"""DataFrame-level operators: rows, cleaning, mapping, expansion, post, quality."""
