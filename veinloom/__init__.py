"""Graph-building and corpus-cleaning operators expressed on PySpark DataFrames."""
