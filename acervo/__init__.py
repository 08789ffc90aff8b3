"""Legal-document analytics on Spark."""
