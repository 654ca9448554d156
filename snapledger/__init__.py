"""snapledger: snapshot ingestion, versioned tables and change analytics on Spark."""
