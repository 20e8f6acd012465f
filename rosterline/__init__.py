"""Record linkage, reconciliation and tabular extraction on Spark DataFrames."""
