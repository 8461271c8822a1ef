"""Raw schemas, partitioned stores and views over the sample tables."""
