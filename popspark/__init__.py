"""popspark: Spark jobs for population-genomics tables.  Operators take and return DataFrames."""
