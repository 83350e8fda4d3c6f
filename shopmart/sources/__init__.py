"""shopmart.sources."""
