"""Jobs: one function per stage, DataFrames in and out."""
