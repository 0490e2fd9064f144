"""Spark operators for payment-card transaction data: ingest, SCD2 dimensions, facts, signals."""
