"""Analytics over archives of versioned artifacts, written as Spark DataFrame jobs."""
