"""Story analytics on Spark: DataFrame operators for document streams."""
