"""tracecut: recordings cut, trimmed, filtered and checked as Spark DataFrame plans."""
