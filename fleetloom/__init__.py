"""Demand, supply and inventory analytics for configurable products, on Spark DataFrames."""
