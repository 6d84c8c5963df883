"""Content-completion features and predictions as Spark DataFrame transformations."""
