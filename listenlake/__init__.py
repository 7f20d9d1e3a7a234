"""Music-service event lake and star schema on Spark DataFrames."""
