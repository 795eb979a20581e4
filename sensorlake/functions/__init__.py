"""sensorlake.functions."""
