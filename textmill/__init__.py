"""textmill: build, label and classify text corpora with Spark DataFrames."""
