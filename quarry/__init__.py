"""quarry: retail documents, weak supervision and evaluation jobs on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a builder of
``Column`` expressions) so that Catalyst sees one declarative plan.
"""

__version__ = "0.1.0"
