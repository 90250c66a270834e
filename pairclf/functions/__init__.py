"""Column functions: names, vectors as text, split buckets, lines, reports."""
