"""kinfold: entity resolution and large-table data processing on Spark DataFrames."""
