"""ratesmith: population-standardised activity indicators on Spark DataFrames."""
