"""Session analytics over web clicks, written with Spark DataFrames."""
