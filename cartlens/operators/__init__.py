"""Metrics and their stages. Each takes DataFrames and returns one lazy DataFrame; none runs an action.

(The label matcher is the exception that must look at its catalogue first; see ``labels``.)
"""
