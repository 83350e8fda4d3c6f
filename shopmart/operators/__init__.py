"""shopmart.operators."""
