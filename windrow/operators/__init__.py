"""Operators on keyed time series and on prediction tables; all take and return DataFrames."""
