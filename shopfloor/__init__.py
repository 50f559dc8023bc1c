"""Retail clienteling analytics on Spark: transaction fact, chat reach and chat ingest."""
