"""turnloom: conversation and preference tables to training-ready tables, on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function and every template a
``Column -> Column`` builder, so pipelines compose with ``df.transform`` and Catalyst
sees one declarative plan.
"""

__version__ = "0.1.0"
