"""Bibliographic tables, property graphs, triples and graph analytics on Spark DataFrames."""
