"""The layers: bronze (ingest), silver (clean), gold (model), checks, monitoring."""
