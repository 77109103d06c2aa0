"""spindle: fair clustering, word count and stream frequency analytics on Spark."""
