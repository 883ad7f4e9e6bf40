"""Operators of a training-data pipeline, each a Spark job over whole tables.

One module per operator; ``catalog`` registers their queries. Nothing outside
this subpackage imports it (``__spark_entry__`` adds the queries when it is
present).
"""
