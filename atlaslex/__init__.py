"""Geo-text analytics on Spark: from article dumps to a labelled map.

The layers, bottom up:

``functions``  Column -> Column expressions (markup, words, coordinate tags, links, geometry)
``operators``  DataFrame -> DataFrame building blocks (bounded joins, ranking, sampling, upserts, k-means, labels)
``sources``    readers for dumps, dictionaries and stage tables
``sinks``      writers for stage tables and exports
``plans``      the user-level stages, from dump pages to map labels
"""
