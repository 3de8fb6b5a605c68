"""Domain jobs: pure functions from DataFrames and ``Params`` to a DataFrame.

Each returns one table or report. Nothing is written or collected here; ``chains`` shows
how the jobs feed each other and where results shared by several jobs are written.
"""
