"""A Spark-native analytics engine for collections of legal briefs and similar long documents."""
