"""tidemark."""
