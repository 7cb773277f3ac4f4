"""Report pipelines: functions from input tables and a reporting date to a DataFrame."""
