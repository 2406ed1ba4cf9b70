"""Card, deck and tournament analytics on Spark DataFrames."""
