"""docloom: a PySpark-native engine for document extraction, merging, monitoring and publishing."""
