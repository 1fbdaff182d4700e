"""groundmill: grounded text enrichment and corpus analytics on Spark DataFrames."""
