"""City-travel lakehouse operators on PySpark DataFrames."""
