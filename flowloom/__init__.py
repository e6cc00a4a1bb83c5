"""Traffic captures to labelled text datasets, and classifier evaluation, on Spark DataFrames."""
