"""quillmill: Spark-native engine for turning exam papers into checked question records."""
