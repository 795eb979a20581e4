"""sensorlake.plans."""
