"""lectern: reader-engagement analytics and corpus processing as Spark DataFrame plans."""
