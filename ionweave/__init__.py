"""Table operators for precursor/fragment identification data, on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames.  Nothing here
holds session state; the session is taken from the input frame.
"""
