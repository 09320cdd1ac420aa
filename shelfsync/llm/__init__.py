"""Training-data operators: chat formatting, mixing, near-duplicate and line
dedup, tokenisation, vector and text search, toxicity, substring dedup, page
extraction, collocations, hard negatives and decontamination.  Nothing else in
the library imports this package."""
