"""Loan-risk analytics written as Spark jobs."""
