"""keysieve — credential-strength and breach-exposure analytics on Spark.

Pure ``DataFrame -> DataFrame`` building blocks; no module creates a session
or fires a job unless its docstring says so.
"""

__version__ = "0.1.0"
