"""corvane: corpus analytics and retrieval as Spark DataFrame operators."""
