"""matchspark: Spark-native analytics for matchup data.

Tables of entities that meet in dated rounds (games between teams in
weeks of seasons) are loaded, validated, joined to both sides' statistics,
turned into ratio / rolling / head-to-head / streak features, split by
time, scaled, scored with ``pyspark.ml`` classifiers and evaluated.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions and windows; column names are parameters.
"""

__version__ = "0.1.0"
