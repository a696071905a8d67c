"""matchloom: entity resolution on PySpark DataFrames."""
