"""Late-order analytics on Spark: integrate, check, clean, report, train, segment and score."""
