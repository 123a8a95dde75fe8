"""Table operators: functions from DataFrames to DataFrames. None of them starts a job."""
