"""Feature building, training, scoring, evaluation and tuning with Spark ML."""
