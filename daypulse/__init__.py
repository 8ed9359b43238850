"""daypulse: daily sensor and activity metrics on Spark.

Every operator is DataFrame in, DataFrame out, and takes ``keys`` (entity
columns such as ``["user_id"]``; ``[]`` means a single entity) so that all
entities and all report periods are computed in one job.
"""

__version__ = "0.1.0"
