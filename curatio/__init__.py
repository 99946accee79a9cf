"""curatio: a Spark-native engine for catalogue curation and corpus preparation."""
