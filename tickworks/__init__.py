"""tickworks — market-tick analytics as Spark DataFrame transforms.

Every transform takes and returns a DataFrame and runs on batch tables and,
where its semantics allow, unchanged on Structured Streaming.
"""

__version__ = "0.1.0"
