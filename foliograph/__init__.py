"""foliograph: document-to-knowledge-graph analytics as declarative Spark plans."""
