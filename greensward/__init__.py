"""Vegetation-change analytics and corpus preparation as Spark DataFrame jobs."""
