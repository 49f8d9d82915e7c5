"""fairsketch: group-fair k-means and stream frequency sketches on Spark DataFrames.

Layout
------
sources/    readers and writers of labelled points and item columns, the point generator
functions/  column-expression building blocks (distances, hash families)
operators/  DataFrame -> DataFrame operators (assignment, objectives, k-means, fair k-means,
            sketches, heavy hitters)
streaming/  Structured Streaming drivers for the sketches
plans/      the named queries run by the checker, their DuckDB oracle SQL, fixed parameters
"""

__version__ = "0.1.0"
