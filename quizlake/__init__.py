"""quizlake: a Spark-native evaluation mart for question-answering benchmarks.

Layers: Bronze item banks (``sources``), Silver graded attempts (``operators.clean``,
``operators.grade``, ``operators.resume``), Gold metrics (``operators.gold``) and the
report tables (``operators.report``). Everything is a DataFrame -> DataFrame (or
Column -> Column) function; nothing pulls rows to the driver.
"""

__version__ = "0.1.0"
