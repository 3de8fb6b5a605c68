"""Registered queries: the operators and the domain plans run on the driver's tables.

``derived`` reshapes the driver's tables into school-board inputs, ``operator_queries`` and
``plan_queries`` run the library on them, and ``oracle_*`` holds the same results in SQL.
"""
