"""mapledger: a publication catalog for large dataset collections, on Spark DataFrames."""
