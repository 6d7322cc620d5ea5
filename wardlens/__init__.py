"""wardlens: hospital-admissions analytics and data-quality operators on Spark.

Every operator takes and returns DataFrames; nothing is collected to the driver
except the small results of explicit actions (counts, a recursion frontier check).
"""

__version__ = "0.1.0"
