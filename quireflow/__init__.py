"""Document-extraction analytics on Spark: scans, filters, tagging, linking and scoring as DataFrame plans."""
