"""The retail operators: functions from DataFrames to DataFrames."""
