"""Feature engineering and model evaluation for large labelled event tables on Spark."""
