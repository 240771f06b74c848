"""Panel, risk-model and decision operators on Spark DataFrames."""
