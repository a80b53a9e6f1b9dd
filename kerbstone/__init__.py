"""kerbstone: street-condition analytics on PySpark."""
