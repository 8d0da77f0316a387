"""leafmill: document-page analytics on Spark."""
