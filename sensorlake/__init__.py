"""sensorlake: Spark-native sensor time-series, resampling, alert-rule and publishing library.

Every public function takes and returns DataFrames (or builds a streaming
query); no function collects data to the driver.
"""

__version__ = "0.1.0"
