"""Customer analytics over a transaction ledger, written as Spark DataFrame jobs."""
