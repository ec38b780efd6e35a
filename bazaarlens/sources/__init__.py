"""Inputs and outputs: declared schemas, CSV ingest, stored tables, star-schema views."""
