"""Schema-adaptive loading of spreadsheet-like feeds, as Spark DataFrame jobs."""
