"""Relational operators of the filings engine: DataFrame in, DataFrame out, all lazy."""
