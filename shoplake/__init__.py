"""shoplake: a real-time e-commerce warehouse on Spark.

Layers: raw app logs and database change records (ods) -> cleaned, split
detail (dwd) -> unique visitors, bounces and order-wide rows (dwm). Each job
has a batch form on DataFrames and a Structured Streaming form that gives the
same rows when nothing arrives late.
"""

__version__ = "0.1.0"
