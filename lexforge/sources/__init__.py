"""Where documents and lists come from; every file is read by Spark's readers."""
