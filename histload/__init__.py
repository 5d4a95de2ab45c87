"""histload: versioned history tables kept from delimited batch files, on Spark DataFrames."""
