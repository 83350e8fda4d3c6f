"""shopmart.plans."""
