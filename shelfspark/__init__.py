"""shelfspark: reading/subscription analytics jobs expressed as Spark DataFrame plans.

Every job takes DataFrames plus explicit parameters and returns a DataFrame; nothing is
collected to the driver except one-row scalars, and nothing leaves the JVM (no UDFs).
"""

__version__ = "0.1.0"
