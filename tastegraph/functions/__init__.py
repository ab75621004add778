"""Column functions and small plan builders shared by the operators."""
