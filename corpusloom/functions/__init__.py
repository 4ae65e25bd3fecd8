"""Column functions: tokenizers, n-grams, stemming, scoring, bibliography fields."""
