"""Link analytics over web-crawl archives, on PySpark DataFrames."""
