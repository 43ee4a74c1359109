"""callweave: conversation-journey analytics as Spark DataFrame jobs.

Grains: lead -> call -> segment -> claim.  Public functions take and return DataFrames.
"""
