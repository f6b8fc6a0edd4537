"""tidemark: event-sourced interval analytics on Spark DataFrames."""
