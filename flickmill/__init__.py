"""flickmill: a Spark-native movie recommendation analytics engine.

Every public function takes and returns DataFrames; cuts and sizes are
parameters whose defaults are the values the recommender was configured with.
"""

__version__ = "0.1.0"
