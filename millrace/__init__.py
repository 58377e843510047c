"""millrace: a Spark-first engine for curating web-sourced datasets."""
