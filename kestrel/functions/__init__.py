"""Per-row expressions, window specifications and output normalisation."""
