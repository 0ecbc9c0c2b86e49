"""Retail catalogue, price and sales analytics on Spark DataFrames.

Layers, from bottom to top:

* ``sources``   partition scans, scope filters, feed unions, Parquet partition writes
* ``functions`` column expressions (text, JSON, crawl strings, weights, keys)
* ``operators`` DataFrame operators (joins, best-value collapse, prices, running shares, rules, bundles, forecast, checks)
* ``plans``     the composed jobs
"""
