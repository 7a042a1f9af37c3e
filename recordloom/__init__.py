"""Analytics over structured records recovered from documents, as Spark DataFrames and SQL."""
