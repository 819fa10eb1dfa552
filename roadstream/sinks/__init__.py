"""Writers for results."""
