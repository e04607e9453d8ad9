"""The engine's operators for DataFrames."""
