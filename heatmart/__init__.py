"""Daily weather panels crossed with public-health indicators, on Spark.

Every public function takes DataFrames (plus plain parameters) and returns a
DataFrame or a Column, so the whole library composes with ordinary Spark code.
"""
