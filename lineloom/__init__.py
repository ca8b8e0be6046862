"""Line-oriented log, evidence and corpus analytics on Spark DataFrames."""
