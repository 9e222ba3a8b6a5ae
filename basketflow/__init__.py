"""basketflow: retail basket sequences and next-basket scoring on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame. See README.md for the module map and
for the rules that keep the plans sound on very large, skewed tables.
"""
