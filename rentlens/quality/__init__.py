"""Data-quality rules, model assertions and gates."""
