"""Ready-made analyses: functions from DataFrames to a result DataFrame."""
