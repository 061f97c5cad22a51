"""Price-transparency analytics on PySpark: nested rate files in, typed and enriched rate tables out."""
