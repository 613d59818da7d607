"""Session analytics and next-item recommendation on Spark DataFrames."""
