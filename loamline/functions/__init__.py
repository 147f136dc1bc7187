"""Column functions: text primitives, cleaning, chunking, quality metrics, categories, pattern matches."""
