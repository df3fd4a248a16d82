"""Machine telemetry on Spark: averages, limits, labels, label changes and controls, in batch and on streams."""
