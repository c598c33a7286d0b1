"""tastemill: recommender-system data jobs on PySpark DataFrames."""
