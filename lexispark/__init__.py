"""Full-text indexing, retrieval, ranking and ranking evaluation on Spark DataFrames."""
