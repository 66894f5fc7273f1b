"""Block-feature tables on Spark: decode, resolve, aggregate, check and store."""
