"""SQL functions users can call by name."""


def register(spark):
    """get_trading_session(time): session of a UTC time, usable from SQL text."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION get_trading_session(at TIMESTAMP DEFAULT current_timestamp())
        RETURNS STRING
        RETURN CASE WHEN hour(at) >= 22 OR hour(at) <= 6 THEN 'Sydney'
                    WHEN hour(at) <= 14 THEN 'London' ELSE 'New_York' END""")
