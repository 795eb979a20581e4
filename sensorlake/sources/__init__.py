"""sensorlake.sources."""
