"""Daily price series and business filings on PySpark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects; no
function creates a session.
"""
