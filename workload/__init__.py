"""Correctness and benchmark queries over the driver's tables.

``inputs`` derives ad data from those tables, ``queries`` runs the library on it and
``oracle`` states the expected result of each query in SQL.
"""
