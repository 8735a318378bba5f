"""User-level extracts (plans) composed from the generic operators."""
