"""Plan shaping shared by the operators: join choice, block splitting, ranking, layout."""
