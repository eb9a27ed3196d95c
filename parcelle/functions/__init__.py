"""Column functions: cleaning, codes, texts, scores and exact order statistics."""
