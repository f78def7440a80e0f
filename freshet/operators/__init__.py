"""Table, spatial and scoring operators: DataFrame in, DataFrame out."""
