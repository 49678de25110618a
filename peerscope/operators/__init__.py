"""Generic relational operators."""
