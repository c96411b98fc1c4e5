"""tidewatch: message trend analytics expressed as Spark DataFrame plans.

Every public operator is a function ``DataFrame -> DataFrame`` (or a Column
expression); no operator collects to the driver or creates a session.
"""

__version__ = "0.1.0"
