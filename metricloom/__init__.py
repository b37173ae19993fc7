"""Product and revenue KPIs as Spark DataFrame operators.

Layers, bottom up: ``sources`` (files, landing, published tables, synthetic
data), ``functions`` (column helpers), ``operators`` (DataFrame in, DataFrame
out) and ``plans`` (marts, serving queries, the publishing job, and the
registry of checked queries).
"""
