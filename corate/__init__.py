"""corate: a collaborative-filtering engine written natively for PySpark.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver and no Python UDF is used. Column names default to
``user_id``, ``item_id`` and ``rating``.
"""

__version__ = "0.1.0"

USER = "user_id"
ITEM = "item_id"
RATING = "rating"
