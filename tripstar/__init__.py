"""Trip-record analytics on Spark: raw files -> validated layers -> star schema -> checks."""
