"""Counter-speech retrieval, assessment and evaluation as Spark DataFrame operators."""
