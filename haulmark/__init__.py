"""haulmark: parcel and freight analytics written as Spark DataFrame jobs."""
