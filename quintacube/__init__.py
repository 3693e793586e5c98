"""Retail star schema and five-way sales cube, written as Spark DataFrame jobs."""
