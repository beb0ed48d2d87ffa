"""quoteflow: quote pricing and quote analytics as PySpark DataFrame jobs and streams."""
