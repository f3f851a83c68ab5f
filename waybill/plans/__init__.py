"""Named jobs composed of operators; each is a function of DataFrames."""
