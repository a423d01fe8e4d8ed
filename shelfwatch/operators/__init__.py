"""Table operators: every one takes and returns DataFrames and stays lazy unless it says otherwise."""
