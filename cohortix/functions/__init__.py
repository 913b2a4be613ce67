"""Column expressions and the distributed statistics the operators share."""
