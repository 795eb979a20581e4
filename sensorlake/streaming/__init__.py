"""sensorlake.streaming."""
