"""Column helpers. Every function takes and returns columns; none is a UDF."""
