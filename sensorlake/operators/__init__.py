"""sensorlake.operators."""
