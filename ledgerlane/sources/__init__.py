"""Table schemas, readers, sinks and the sample-data mapping."""
