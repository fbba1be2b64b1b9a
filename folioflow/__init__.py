"""Folioflow: paginated legal and parliamentary documents as relations, on Spark DataFrames."""
