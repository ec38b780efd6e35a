"""The reports, as functions from tables (and parameters) to a DataFrame."""
