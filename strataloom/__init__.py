"""strataloom: layered-warehouse operators on Spark DataFrames.

Raw feed records are typed and classified, detail tables keep versioned
dimensions, bridges and hourly facts, and marts summarise them.  Every operator
takes DataFrames and returns a lazy DataFrame; time is always an argument.
"""

__version__ = "0.1.0"
