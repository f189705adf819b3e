"""kinfold: entity resolution, record merging and corpus preparation on Spark DataFrames."""
