"""Site traffic, page funnel and experiment reporting as Spark DataFrame operators."""
