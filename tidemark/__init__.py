"""A PySpark-native analytics engine for collections of research documents."""
