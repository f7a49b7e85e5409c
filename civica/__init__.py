"""civica: Spark-native analytics for election results and socio-economic indicators.

Every operator is a plain ``DataFrame -> DataFrame`` function whose column
names are parameters.  Nothing is collected to the driver except schema
metadata and bounded scalars; the heavy lifting stays in Catalyst plans.
"""

__version__ = "0.1.0"
