"""waybill: logistics message analytics on PySpark."""
