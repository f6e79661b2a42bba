"""truant: Spark-native analytics for medical-appointment no-shows.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) or a small *fit* that returns frozen state plus a
*transform* that applies it.  Heavy work stays in Spark SQL / MLlib.
"""

__version__ = "0.1.0"
