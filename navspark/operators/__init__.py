"""Relational and window operators over the NAV model. Each is a pure
``DataFrame -> DataFrame`` function built only on Spark built-ins."""
