"""Business analytics and data-quality review on Spark DataFrames."""
