"""Log analytics on Spark: parse, classify, window, alert and deliver application logs."""
