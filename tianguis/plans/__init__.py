"""Each module turns DataFrames into the DataFrames of one layer."""
