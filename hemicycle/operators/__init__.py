"""Generic relational operators; column names are arguments."""
