"""doctriage: document classification as Spark DataFrame operations.

Discover documents, extract text, build classification prompts, score them with a
pluggable scorer, parse the free-text answers into typed results, band their
confidence, route low confidence to review and report on the batch.
"""

__version__ = "0.1.0"
