"""Transaction-risk analytics on PySpark: batch, streaming and models over one set of operators."""
