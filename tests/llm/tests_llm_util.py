def collected(df):
    """All rows in a fixed order."""
    return sorted(df.collect(), key=repr)
