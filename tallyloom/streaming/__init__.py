"""Features kept up to date day by day."""
