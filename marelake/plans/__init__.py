"""Table specs, layer runs and the domain models built on the operators."""
