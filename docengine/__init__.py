"""docengine: document-record extraction and corpus preparation on Spark."""
