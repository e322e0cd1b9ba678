"""Financial analytics on Spark: raw files to typed tables, marts, scores, forecasts and search."""
