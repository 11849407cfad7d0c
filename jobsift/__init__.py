"""jobsift: Spark-native job-posting cleaning, upsert and star-schema engine."""

__version__ = "0.1.0"
