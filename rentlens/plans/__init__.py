"""The models: canonical listing, staging, enriched, star schema and marts."""
