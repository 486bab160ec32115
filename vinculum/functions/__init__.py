"""Column-expression building blocks (text normalisation, fingerprints, validation)."""
