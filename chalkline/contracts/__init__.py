"""Versioned data contracts (YAML), loaded by ``chalkline.operators.contracts``."""
