"""Expression-level helpers shared by the operators."""
