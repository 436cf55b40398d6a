"""The label and salt helpers for SQL users, as temporary SQL functions."""

from pyspark.sql import SparkSession

_DEFINITIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(number BIGINT, text STRING, sep STRING)
       RETURNS STRING RETURN concat_ws(sep, CAST(number AS STRING), text)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION random_prefix(text STRING, n INT)
       RETURNS STRING NOT DETERMINISTIC
       RETURN concat(CAST(floor(rand() * n) AS STRING), '_', text)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION remove_random_prefix(text STRING)
       RETURNS STRING RETURN regexp_replace(text, '^[0-9]+_', '')""",
]


def register(spark: SparkSession) -> None:
    """Make the functions known to ``spark.sql`` (JSON access is built in)."""
    for definition in _DEFINITIONS:
        spark.sql(definition)
