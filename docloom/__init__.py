"""docloom: a Spark-native engine for document pipelines and the queue analytics around them."""
