"""Training-data operators (license scan, packing, near-dedup, language ID, ...). Nothing outside imports this."""
