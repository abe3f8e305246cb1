"""tablekit: scans, loads, interval models, quality checks and run analytics on Spark."""
